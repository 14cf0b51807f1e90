"""Repeated passages: suffixes of 35 words, grouped by prefixes; no suffix tree is built.

A window is 35 consecutive words of one document. Every word that is covered by a window
whose word sequence also starts anywhere else, in the same document or another, is removed;
windows are judged on the input. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.

1. Equal texts are one text with a number of copies. With copies, each of its windows
   starts elsewhere; what is left is to compare different texts.
2. Each window is led by its smallest 8-word prefix (a minimizer): the windows around it
   are suffixes of the text that share this prefix, at the same distance in every place
   where they occur. Only prefixes with more than one place are kept.
3. Suffixes with one prefix form a group. Groups of up to 512 places are put side by side
   in memory: the suffixes are cut to 35 words and sorted, and neighbours are compared for
   equality. For larger groups the prefix becomes the full 35 words; then the size of the group alone tells what repeats, and it is
   counted with partial sums, never gathered.
4. The repeated windows of a text are merged into passages, and these are cut out.

A word is compared by a 48-bit number in step 3, next to a shared prefix of eight words
with 64 bits; longer prefixes have 128 bits.

Rows: null and empty texts have no words; nothing is removed, and the digest is that of the
empty text. Repeated rows are copies of each other. A doc_id may be null. Texts of any
length are handled whole. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import chunks, gram_numbers, stored, word_numbers

WINDOW = 35
PREFIX = 8
SPAN = WINDOW - PREFIX + 1
#: Places of one prefix that are sorted together in memory.
GROUP = 512
#: Places whose groups a task sorts in one go.
BATCH = 4096
WORD_BYTES = 6
EMPTY = hashlib.sha256(b"").hexdigest()


def leaders(numbers: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The leading prefix of all windows of some texts, laid end to end.

    Returns the prefixes' numbers, the places of the leaders, and the first and the last
    window that each of them leads, all counted over all words.
    """
    none = np.zeros(0, np.int64)
    grams = gram_numbers(numbers, PREFIX)
    n = len(numbers) - WINDOW + 1
    if n <= 0:
        return grams, none, none, none
    value, place = grams, np.arange(len(grams))
    for step in (1, 2, 4, 8, SPAN - 16):
        size = len(value) - step
        right = value[step:] < value[:size]
        place = np.where(right, place[step:], place[:size])
        value = np.minimum(value[step:], value[:size])
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    if not len(inside):
        return grams, none, none, none
    lead = place[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (np.diff(lead) != 0) | (np.diff(inside) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(inside)) - 1
    return grams, lead[first], inside[first], inside[last]


def _places(docs: DataFrame) -> DataFrame:
    """prefix, t1, t2 and at of each leader of each row."""
    schema = pa.schema([("prefix", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for start, part in chunks(batch.column(2).to_pylist()):
                numbers, begins = word_numbers(part)
                grams, lead, _, _ = leaders(numbers, begins)
                row = np.searchsorted(begins, lead, side="right") - 1
                at = (lead - begins[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[lead].view(np.int64)), pa.array(t1[start + row]), pa.array(t2[start + row]), pa.array(at)], schema=schema
                )

    return docs.select("t1", "t2", "text").mapInArrow(run, "prefix long, t1 long, t2 long, at int")


CONTEXT = "array<struct<prefix: long, window: int, n_windows: int, words: binary>>"
TEXT_DDL = f"t1 long, t2 long, n_words long, kept string, text string, contexts {CONTEXT}"


def _contexts(rows: DataFrame) -> DataFrame:
    """Per text: what stays of it if nothing repeats, else its text and its open places.

    A place brings the words of all windows that its prefix leads.
    """
    names = ("t1", "t2", "n_words", "kept", "text", "contexts")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        places: list[tuple[np.ndarray, ...]] = []
        words: list[bytes] = []
        size = 0

        def made() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            flat = [np.concatenate(x) if places else np.zeros(0, np.int64) for x in zip(*places, strict=True)] or [np.zeros(0, np.int64)] * 3
            kinds = (pa.int64(), pa.int32(), pa.int32())
            values = pa.StructArray.from_arrays(
                [*[pa.array(x).cast(k) for x, k in zip(flat, kinds, strict=True)], pa.array(words, pa.binary())],
                names=["prefix", "window", "n_windows", "words"],
            )
            offsets = np.cumsum([0, *[len(p[0]) for p in places]]).astype(np.int32)
            return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), values)], names=names)

        none = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            for t1, t2, text, spots in zip(*[batch.column(c) for c in range(4)], strict=True):
                text = text.as_py()
                data = text.encode("utf-8", "surrogatepass")
                if not spots.is_valid:
                    found = data.split()
                    rows.append((t1.as_py(), t2.as_py(), len(found), hashlib.sha256(b" ".join(found)).hexdigest(), None))
                    places.append(none)
                else:
                    numbers, begins = word_numbers([data])
                    grams, lead, first, last = leaders(numbers, begins)
                    keep = np.isin(lead, spots.values.to_numpy())
                    lead, first, last = lead[keep], first[keep], last[keep]
                    short = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]).tobytes()
                    words += [short[a * WORD_BYTES : (b + WINDOW) * WORD_BYTES] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                    rows.append((t1.as_py(), t2.as_py(), len(numbers), None, text))
                    places.append((grams[lead].view(np.int64), first, last - first + 1))
                    size += len(data) + len(first) * 300
                if len(rows) == 1000 or size > 8 << 20:
                    yield made()
                    rows.clear()
                    places.clear()
                    words.clear()
                    size = 0
        if rows:
            yield made()

    return rows.select("t1", "t2", "text", "spots").mapInArrow(run, TEXT_DDL)


def repeated_suffixes(suffixes: np.ndarray) -> np.ndarray:
    """Which rows of words have an internal node of full depth above them.

    The rows are sorted as the leaves of the suffix tree are; two neighbours meet in a node
    whose depth is the length of their common prefix.
    """
    flat = np.ascontiguousarray(suffixes).view(np.dtype((np.void, suffixes.shape[1]))).reshape(-1)
    order = np.argsort(flat)
    leaves = flat[order]
    deep = leaves[1:] == leaves[:-1]
    out = np.zeros(len(flat), bool)
    out[order[1:][deep]] = True
    out[order[:-1][deep]] = True
    return out


PASSAGE_DDL = "t1 long, t2 long, first int, until int"


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages from places sorted by prefix; whole groups are sorted in memory."""

    def passages(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(tables)
        words = [np.frombuffer(w.as_buffer(), np.uint8) for w in rows.column("words")]
        counts = rows.column("n_windows").to_numpy()
        size = WINDOW * WORD_BYTES
        suffixes = np.concatenate(
            [np.lib.stride_tricks.as_strided(w, (n, size), (WORD_BYTES, 1)) for w, n in zip(words, counts, strict=True)]
        )
        again = repeated_suffixes(suffixes)
        row = np.repeat(np.arange(len(counts)), counts)
        window = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + rows.column("window").to_numpy()[row]
        hit = np.flatnonzero(again)
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)
        a, b = hit[new], hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else hit
        t1, t2 = rows.column("t1").to_numpy(), rows.column("t2").to_numpy()
        made = [t1[row[a]], t2[row[a]], window[a].astype(np.int32), (window[b] + WINDOW).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["t1", "t2", "first", "until"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        prefix = batch.column(0).to_numpy()
        edges = np.append(np.flatnonzero(np.diff(prefix)) + 1, len(prefix))
        start = 0
        if held and prefix[0] != held[-1].column(0)[-1].as_py() and size >= BATCH:
            yield passages(held)
            held, size = [], 0
        for edge in edges[:-1]:
            if size + edge - start >= BATCH:
                held.append(batch.slice(start, edge - start))
                yield passages(held)
                held, size, start = [], 0, edge
        held.append(batch.slice(start))
        size += len(prefix) - start
    if held:
        yield passages(held)


def _full_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """w1, w2 (the whole window as prefix), t1, t2 and first of each window of large groups."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.uint8).reshape(-1, WORD_BYTES)
        raw = np.zeros((len(data), 8), np.uint8)
        raw[:, :WORD_BYTES] = data
        numbers = raw.view("<u8").reshape(-1)
        windows = batch.column("n_windows").to_numpy()
        # Places lie end to end; the windows of each are the first of its stretch of words.
        size = windows + WINDOW - 1
        at = np.repeat(np.arange(len(windows)), windows)
        step = np.arange(len(at)) - np.repeat(np.cumsum(windows) - windows, windows)
        spot = (np.cumsum(size) - size)[at] + step
        w1 = gram_numbers(numbers, WINDOW)[spot]
        w2 = gram_numbers(numbers * np.uint64(0x9FB21C651E98DF25) + np.uint64(1), WINDOW)[spot]
        t1, t2 = batch.column("t1").to_numpy()[at], batch.column("t2").to_numpy()[at]
        first = (batch.column("window").to_numpy()[at] + step).astype(np.int32)
        made = [w1.view(np.int64), w2.view(np.int64), t1, t2, first]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["w1", "w2", "t1", "t2", "first"])


def _cut(rows: DataFrame) -> DataFrame:
    """n_removed and kept of texts with their passages."""
    schema = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words = r["text"].encode("utf-8", "surrogatepass").split()
                edge = np.zeros(len(words) + 1, np.int64)
                for p in r["passages"] or []:
                    edge[p["first"]] += 1
                    edge[p["until"]] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                kept = [words[i] for i in np.flatnonzero(stay)]
                out.append(
                    {"t1": r["t1"], "t2": r["t2"], "n_words": len(words), "n_removed": len(words) - len(kept), "kept": hashlib.sha256(b" ".join(kept)).hexdigest()}
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.select("t1", "t2", "text", "passages").mapInArrow(run, "t1 long, t2 long, n_words long, n_removed long, kept string")


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))


def passages(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts of ``docs``, one row each, and the passages of them that repeat.

    Texts: t1, t2 (their key), n_words, and kept (a digest) or text. Passages: t1, t2, and
    the words ``first`` to ``until`` (exclusive). Copies of a whole text are not counted.
    """
    rows = keyed(docs)
    places = _places(rows)
    where = F.struct("t1", "at")
    repeated = places.groupBy("prefix").agg(F.min(where).alias("a"), F.max(where).alias("b")).where("a != b").select("prefix")
    spots = places.join(repeated, "prefix").groupBy("t1", "t2").agg(F.collect_set("at").alias("spots"))
    texts = rows.select("t1", "t2", "text").dropDuplicates(["t1", "t2"]).join(stored(spots, "spots"), ["t1", "t2"], "left")
    texts = stored(_contexts(texts), "texts")

    open_ = texts.where("text IS NOT NULL").select("t1", "t2", F.explode("contexts").alias("c"))
    open_ = open_.select("c.prefix", "t1", "t2", "c.window", "c.n_windows", "c.words")
    sizes = texts.select(F.explode("contexts.prefix").alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n"))
    large = stored(sizes.where(F.col("n") > GROUP).select("prefix"), "large")
    small = open_.join(large, "prefix", "left_anti").repartition("prefix").sortWithinPartitions("prefix")
    found = stored(small.mapInArrow(_subtrees, PASSAGE_DDL), "passages")

    full = open_.join(large, "prefix", "left_semi").mapInArrow(_full_prefixes, "w1 long, w2 long, t1 long, t2 long, first int")
    often = full.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    more = full.join(often, ["w1", "w2"]).select("t1", "t2", "first", (F.col("first") + WINDOW).cast("int").alias("until"))
    return texts, found.union(stored(more, "passages"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row of ``docs``."""
    texts, found = passages(docs)
    grouped = found.groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "until")).alias("passages"))
    cut = _cut(texts.where("text IS NOT NULL").select("t1", "t2", "text").join(grouped, ["t1", "t2"], "left"))
    whole = texts.where("text IS NULL").select("t1", "t2", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept")
    rows = keyed(docs).select("doc_id", "t1", "t2")
    copies = rows.groupBy("t1", "t2").agg(F.count("*").alias("copies"))
    copied = (F.col("copies") > 1) & (F.col("n_words") >= WINDOW)
    result = cut.unionByName(whole).join(copies, ["t1", "t2"]).select(
        "t1",
        "t2",
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copied, F.lit(EMPTY)).otherwise(F.col("kept")).alias("kept_sha256"),
    )
    return rows.join(stored(result, "kept"), ["t1", "t2"]).select("doc_id", "n_words", "n_removed", "kept_sha256")
