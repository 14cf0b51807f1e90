"""Token ids in files, packed by a static range asymmetric numeral system.

1. Encode: documents are dealt by ranges of doc_id, every whole text is encoded, and the
   plain ids are stored in blocks of whole documents, with the counts of ids of each file.
2. Pack: the summed counts of all ids of all documents become one shared frequency table (its size
   is that of the vocabulary, whatever the corpus). Each block is then packed by itself,
   with 128 interleaved lanes, checkpoints to start inside it, and a checksum.
3. Read: blocks are decoded in parallel; starts are sums over file totals.

A folder holds the Parquet datasets ``table`` (id, freq), ``blocks``, and ``plain``, which
is not read again and may be deleted. A block's bytes
are in ``payload``: four little-endian 32-bit numbers (tokens, lanes, checkpoints, stream
words), the checkpoints (stream position, then one 64-bit state per lane; the first is
the block's beginning), and the stream of 32-bit words.

Rows: a null text counts as empty, and an empty one has the end id alone. Repeated rows
stay, next to each other, ordered by text; a null doc_id comes first. An empty table gives
an empty folder and no rows. A block whose checksum is wrong fails the read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymark.llm.common import shared_folder, slices

END_ID = 2
#: Bits of the sum of all frequencies: room for a vocabulary of a quarter of a million ids.
SCALE = 18
LANES = 128
#: A block ends with the first document that brings it to so many tokens.
BLOCK_TOKENS = 1 << 16
#: Steps, each of one token per lane, between two checkpoints.
CHECKPOINT_STEPS = 128
#: Blocks that numpy packs or unpacks side by side.
BLOCKS_TOGETHER = 24
#: Pieces that a worker remembers, twice over, before it forgets those not met again.
REMEMBERED = 500_000
#: Bytes of text whose pieces are numbered together; a longer text stands alone.
ENCODED_BYTES = 8 << 20
#: Marks that, after letters, form one token group of their own; fixed by the tokenizer.
MARKS = ".,;:!?*$%&#|()[]+-_=/"

LOWEST = np.uint64(1 << 31)
WORD_BITS = np.uint64(32)
LOW_WORD = np.uint64(0xFFFFFFFF)
PLAIN_DDL = (
    "file_no int, block_no int, ids binary, docs array<struct<doc_id: long, at: long, n_tokens: long>>, "
    "counts binary"
)
BLOCK_DDL = (
    "file_no int, block_no int, n_tokens long, crc32 long, payload binary, "
    "docs array<struct<doc_id: long, at: long, n_tokens: long>>"
)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


class Irregular(Exception):
    """White space next to white space: the text has to be encoded in one piece."""


class Encoder(dict):
    """The ids, as bytes, of each piece met so far; one per worker process and file.

    A piece is what stands between two spaces. It begins with a line end or else follows a
    space. The tokenizer's own rules never join anything over these borders, so the ids of
    a text are those of its pieces, one after the other. A text with the name of an added
    token in it is encoded in one piece.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        # Names of added tokens inside a text are tokens of their own: whole texts only.
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.line_end = self.whole("\n")

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.kind).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.older.get(piece)) is not None:
            self[piece] = ids
            return ids
        begins_line = piece[:1] == "\n"
        word = piece[1:] if begins_line else piece
        if not word or word[0].isspace():
            raise Irregular
        stem = word.rstrip(MARKS)
        if stem.isalpha():  # one letter run and one run of marks: the model alone will do
            if len(stem) < len(word):
                tail = word[len(stem) :]
                if tail not in self.marks:
                    self.marks[tail] = self.whole(tail)
                ids = self[piece[: len(piece) - len(tail)]] + self.marks[tail]
                self[piece] = ids
                return ids
            if not stem.isascii():
                stem = stem.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_LETTERS)
            found = self.model.tokenize(stem if begins_line else BYTE_LETTERS[32] + stem)
            ids = array(self.code, [t.id for t in found]).tobytes()
            if begins_line:
                ids = self.line_end + ids
        else:
            ids = self.whole(piece if begins_line else " " + piece)
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, one after the other."""
        return self.encode_all(pa.array([text]))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text. Distinct pieces are looked up once for all texts; the ids of
        the texts are then gathered by the numbers of their pieces."""
        lined = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        split = pc.split_pattern(lined, " ")
        firsts = split.offsets.to_numpy()[:-1]
        coded = split.flatten().dictionary_encode()
        known, irregular = [], []
        for i, piece in enumerate(coded.dictionary.to_pylist()):
            try:
                known.append(self[piece])
            except Irregular:
                known.append(b"")
                irregular.append(i)
        if len(self) > REMEMBERED:  # what is not met again in the next round is forgotten
            self.older = dict(self)
            self.clear()
            self.marks.clear()
        width = self.kind.itemsize
        codes = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // width
        taken = sizes[codes]
        ends = np.cumsum(taken)
        shift = (np.cumsum(sizes) - sizes)[codes] - (ends - taken)
        ids = np.frombuffer(b"".join(known), self.kind)[np.repeat(shift, taken) + np.arange(ends[-1] if len(ends) else 0)]
        data = memoryview(ids).cast("B") if len(ids) else memoryview(b"")
        # Each text was given a line end before it, whose id goes again.
        begins = ((ends - taken)[firsts] * width + len(self.line_end)).tolist()
        stops = [*((ends - taken)[firsts[1:]] * width).tolist(), len(data)]
        odd = np.zeros(len(known), bool)
        odd[irregular] = True
        whole = np.logical_or.reduceat(odd[codes], firsts) if len(firsts) else np.zeros(0, bool)
        for name in self.added:
            whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        out = [bytes(data[a:b]) for a, b in zip(begins, stops, strict=True)] if len(firsts) else []
        for i in np.flatnonzero(whole):
            out[i] = self.whole(texts[int(i)].as_py())
        return out


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    stand for themselves, all others for the code points from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def count_ids(plain: DataFrame) -> DataFrame:
    """id and n of all stored documents, end ids included; each task that encoded has left
    one row with its counts of all ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                own = np.frombuffer(counts.as_buffer(), "<i8")
                total = np.pad(total, (0, max(0, len(own) - len(total))))
                total[: len(own)] += own
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    counts = plain.where(F.col("block_no").isNull()).select("counts")
    return counts.mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def frequencies(ids: np.ndarray, counts: np.ndarray, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Whole frequencies that sum to 2**scale, at least one for each id that occurs."""
    order = np.lexsort((ids, -counts))
    ids, counts = ids[order], counts[order]
    if len(ids) > 1 << scale:
        raise ValueError("more ids than the frequency table has room for")
    freq = np.maximum(1, np.floor(counts / counts.sum() * (1 << scale)).astype(np.int64))
    rest = (1 << scale) - int(freq.sum())
    if rest > 0:
        freq[0] += rest
    i = 0
    while rest < 0:  # ones that were rounded up are taken from the largest
        take = min(-rest, int(freq[i]) - max(1, int(freq[i]) // 2))
        freq[i] -= take
        rest += take
        i = (i + 1) % len(freq)
    back = np.argsort(ids)
    return ids[back], freq[back]


class Coder:
    """Packs and unpacks blocks with one frequency table."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, scale: int = SCALE) -> None:
        self.scale = np.uint64(scale)
        size = int(ids.max()) + 1
        cumulated = np.concatenate([[0], np.cumsum(freq)])[:-1]
        self.freq, self.cum = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[ids], self.cum[ids] = freq, cumulated
        self.both = (self.freq << WORD_BITS) | self.cum
        self.symbol = np.repeat(ids, freq).astype(np.int32 if size > 1 << 16 else np.uint16)
        self.slots = np.uint64((1 << scale) - 1)

    def pack(self, blocks: list[np.ndarray]) -> list[bytes]:
        """Bytes of each block; the blocks are packed side by side."""
        sizes = np.array([len(b) for b in blocks])
        steps = -(-sizes // LANES)
        most = int(steps.max())
        ids = np.zeros((len(blocks), most * LANES), np.int64)
        for i, block in enumerate(blocks):
            ids[i, : len(block)] = block
        ids = ids.reshape(len(blocks), most, LANES)
        place = np.arange(most * LANES).reshape(most, LANES)
        full = int((sizes // LANES).min())
        x = np.full((len(blocks), LANES), LOWEST, np.uint64)
        limit = (LOWEST >> self.scale) << WORD_BITS
        words, counts = [], np.zeros((most, len(blocks)), np.int64)
        states: dict[int, np.ndarray] = {}
        for t in range(most - 1, -1, -1):
            s = ids[:, t, :]
            c = self.both[s]
            f = c >> WORD_BITS
            c &= LOW_WORD
            if t >= full:
                live = place[t][None, :] < sizes[:, None]
                f = np.where(live, f, np.uint64(1))
                spill = (x >= limit * f) & live
            else:
                live = None
                spill = x >= limit * f
            words.append((x & LOW_WORD)[spill].astype("<u4"))
            counts[t] = spill.sum(axis=1)
            x = np.where(spill, x >> WORD_BITS, x)
            q = x // f
            y = (q << self.scale) + (x - q * f) + c
            x = y if live is None else np.where(live, y, x)
            if t % CHECKPOINT_STEPS == 0:
                states[t] = x.copy()
        flat = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        owner = np.repeat(np.tile(np.arange(len(blocks)), most), counts.reshape(-1))
        before = np.concatenate([np.zeros((1, len(blocks)), np.int64), np.cumsum(counts, axis=0)])
        out = []
        for i in range(len(blocks)):
            stream = flat[owner == i]
            marks = [t for t in sorted(states) if t < steps[i]] or [0]
            head = struct.pack("<4I", int(sizes[i]), LANES, len(marks), len(stream))
            body = b"".join(struct.pack("<Q", int(before[t, i])) + states[t][i].astype("<u8").tobytes() for t in marks)
            out.append(head + body + stream.tobytes())
        return out

    def unpack(self, payloads: list[bytes], first_mark: int = 0) -> list[np.ndarray]:
        """The ids of each block, from its checkpoint number ``first_mark`` on."""
        sizes, offsets, x, streams = [], [], [], []
        for data in payloads:
            n, lanes, marks, words = struct.unpack_from("<4I", data)
            if lanes != LANES or first_mark >= marks:
                raise ValueError("not a block of this format, or no such checkpoint")
            at = 16 + first_mark * 8 * (1 + LANES)
            offsets.append(struct.unpack_from("<Q", data, at)[0])
            x.append(np.frombuffer(data, "<u8", LANES, at + 8))
            streams.append(np.frombuffer(data, "<u4", words, 16 + marks * 8 * (1 + LANES)))
            sizes.append(max(0, n - first_mark * CHECKPOINT_STEPS * LANES))
        sizes = np.array(sizes)
        most = int((-(-sizes // LANES)).max())
        x = np.stack(x).astype(np.uint64)
        base = np.concatenate([[0], np.cumsum([len(s) for s in streams])])[:-1]
        next_word = base + np.array(offsets)
        stream = np.concatenate([*streams, np.zeros(1, "<u4")]).astype(np.uint64)
        out = np.zeros((len(payloads), most, LANES), np.int32)
        place = np.arange(most * LANES).reshape(most, LANES)
        full = int((sizes // LANES).min())
        for t in range(most):
            slot = x & self.slots
            s = self.symbol[slot]
            c = self.both[s]
            y = (c >> WORD_BITS) * (x >> self.scale) + slot - (c & LOW_WORD)
            need = y < LOWEST
            if t >= full:
                live = place[t][None, :] < sizes[:, None]
                need &= live
                y = np.where(live, y, x)
            out[:, t, :] = s
            at = next_word[:, None] + np.cumsum(need, axis=1) - 1
            fill = stream[np.where(need, at, 0)]
            x = np.where(need, (y << WORD_BITS) | fill, y)
            next_word = next_word + need.sum(axis=1)
        return [out[i].reshape(-1)[: sizes[i]] for i in range(len(payloads))]


def _plain_blocks(rows: DataFrame, path: str) -> DataFrame:
    """Blocks of whole documents with their ids as they are, in ascending doc_id order, and
    per file one more row, without a block number, that counts its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        end = np.array([END_ID], encoder.kind).tobytes()
        file_no = TaskContext.get().partitionId()
        parts: list[bytes] = []
        index: list[dict] = []
        size, at, block_no = 0, 0, 0
        counts = np.zeros(max(encoder.vocabulary, END_ID + 1), "<i8")

        def block() -> pa.RecordBatch:
            ids = b"".join(parts)
            counts[:] += np.bincount(np.frombuffer(ids, encoder.kind), minlength=len(counts))
            row = {"file_no": file_no, "block_no": block_no, "ids": ids, "docs": index}
            return pa.RecordBatch.from_pylist([row], schema=PLAIN_SCHEMA)

        parts_of_texts = (part for batch in batches for part in slices(batch, 1, ENCODED_BYTES))
        for part in parts_of_texts:
            for key, ids in zip(part.column(0).to_pylist(), encoder.encode_all(part.column(1)), strict=True):
                n = len(ids) // encoder.kind.itemsize + 1
                parts += [ids, end]
                index.append({"doc_id": key, "at": at, "n_tokens": n})
                size, at = size + n, at + n
                if size >= BLOCK_TOKENS:
                    yield block()
                    parts, index, size, block_no = [], [], 0, block_no + 1
        if index:
            yield block()
        if at:
            yield pa.RecordBatch.from_pylist([{"file_no": file_no, "counts": counts.tobytes()}], schema=PLAIN_SCHEMA)

    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, PLAIN_DDL)


def write_token_files(docs: DataFrame, folder: str, *, path: str | None = None) -> None:
    """Write the documents' ids, each followed by the end id, in ascending doc_id order."""
    path = path or tokenizer_path()
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    _plain_blocks(rows, path).write.option("compression", "zstd").parquet(f"{folder}/plain")
    plain = spark.read.schema(PLAIN_DDL).parquet(f"{folder}/plain")
    kind = Encoder.of(path).kind
    table = count_ids(plain).toPandas()
    ids, freq = (
        frequencies(table["id"].to_numpy(np.int64), table["n"].to_numpy(np.int64))
        if len(table)
        else (np.array([END_ID]), np.array([1 << SCALE]))
    )
    shared = pa.table({"id": pa.array(ids, pa.int32()), "freq": pa.array(freq, pa.int64())})
    spark.createDataFrame(shared).coalesce(1).write.parquet(f"{folder}/table")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ids, freq)
        for part in _together(batches, lambda r: len(r["ids"]) // kind.itemsize):
            packed = coder.pack([np.frombuffer(r["ids"], kind) for r in part])
            rows = [
                {k: r[k] for k in ("file_no", "block_no", "docs")}
                | {"n_tokens": len(r["ids"]) // kind.itemsize, "crc32": zlib.crc32(p), "payload": p}
                for r, p in zip(part, packed, strict=True)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=BLOCK_SCHEMA)

    packed = plain.where(F.col("block_no").isNotNull()).drop("counts").mapInArrow(run, BLOCK_DDL)
    packed.write.parquet(f"{folder}/blocks")


def _together(batches: Iterator[pa.RecordBatch], size_of: Callable[[dict], int]) -> Iterator[list[dict]]:
    """Blocks in groups for numpy; one with a very long document comes alone."""
    part: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if size_of(row) > 2 * BLOCK_TOKENS:
                yield [row]
                continue
            part.append(row)
            if len(part) == BLOCKS_TOGETHER:
                yield part
                part = []
    if part:
        yield part


DOCS_TYPE = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())]))
PLAIN_SCHEMA = pa.schema(
    [
        ("file_no", pa.int32()),
        ("block_no", pa.int32()),
        ("ids", pa.binary()),
        ("docs", DOCS_TYPE),
        ("counts", pa.binary()),
    ]
)
BLOCK_SCHEMA = pa.schema(
    [
        ("file_no", pa.int32()),
        ("block_no", pa.int32()),
        ("n_tokens", pa.int64()),
        ("crc32", pa.int64()),
        ("payload", pa.binary()),
        ("docs", DOCS_TYPE),
    ]
)


def read_token_files(spark: SparkSession, folder: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document in ``folder``."""
    table = spark.read.parquet(f"{folder}/table").toPandas()
    ids, freq = table["id"].to_numpy(np.int64), table["freq"].to_numpy(np.int64)
    blocks = spark.read.schema(BLOCK_DDL).parquet(f"{folder}/blocks")
    # One row per file: the tokens of all files before it.
    files = blocks.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("file_no").rowsBetween(W.unboundedPreceding, -1))
    files = files.select(F.col("file_no").alias("file"), F.coalesce(before, F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ids, freq)
        for batch in batches:
            for part in _together(iter([batch]), lambda r: r["n_tokens"]):
                for r in part:
                    if zlib.crc32(r["payload"]) != r["crc32"]:
                        raise ValueError(f"checksum of block {r['block_no']} of file {r['file_no']}")
                out = []
                for r, found in zip(part, coder.unpack([r["payload"] for r in part]), strict=True):
                    found = found.astype("<u4")
                    base = r["docs"][0]["at"]
                    for d in r["docs"]:
                        own = found[d["at"] - base : d["at"] - base + d["n_tokens"]]
                        made = {"file_no": r["file_no"], "doc_id": d["doc_id"], "at": d["at"], "n_tokens": d["n_tokens"], "ids_crc32": zlib.crc32(own.tobytes())}
                        out.append(made | {"ids": own.astype(np.int32)} if with_ids else made)
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    fields = [("file_no", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
    ddl = "file_no int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    found = blocks.mapInArrow(run, ddl)
    joined = found.join(files, F.col("file_no") == F.col("file"))
    start = (F.col("at") + F.col("before")).alias("start")
    return joined.select("doc_id", start, "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_files(docs: DataFrame, folder: str | None = None, *, path: str | None = None) -> DataFrame:
    """Write the files of ``docs`` and return what they hold."""
    folder = folder or f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, folder, path=path)
    return read_token_files(docs.sparkSession, folder)
