"""Near-duplicate documents: a Jaccard join on word shingles with Bayesian pruning.

A document's shingles are its runs of five words, unchanged; one to four words are a single
shingle. Documents with one and the same set of shingles are copies of each other and go
through the join once. Two different sets are linked if their Jaccard similarity is at
least 0.8. The result has one row per document: its class (the smallest doc_id that links
lead to) and the number of its links, copies included.

How the join is done, with nothing emitted per pair:

1. Each set gets 160 MinHash values. 32 bands of five of them are buckets; a pair at the
   threshold shares none with a probability of 3e-6.
2. Sets that share a bucket with another are dealt into blocks of bounded size by the
   largest bucket that they or their neighbours are in, so that a group of near copies shares blocks however large it is. Pairs
   of blocks with a bucket in common are compared; a hot bucket becomes many such pairs.
3. In a pair of blocks, MinHash values are compared 16 at a time. A pair of sets is dropped
   once the posterior probability of reaching the threshold, for a uniform prior, is below
   1e-6. What remains is verified with exact intersections.
4. Links are added up per set, and each block pair gives a spanning forest only; classes
   are the components of these forests, by alternating large and small stars.

Rows: null and empty texts and texts of white space alone have no shingles and no links;
each is a class of its own. Repeated rows are copies. A null doc_id keeps its row; it is
the class only where the class has no other.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import SHINGLE_WORDS, SIMILARITY, chunks, gram_numbers, slices, stored, word_numbers

BANDS = 32
BAND_ROWS = 5
HASHES = BANDS * BAND_ROWS
STEP = 16
TOLERANCE = 1e-6
#: A block ends at so many sets or shingles; a single set may be larger.
BLOCK_SETS = 2048
BLOCK_SHINGLES = 400_000
#: Sets of the left block whose pairs are looked at together.
ROWS = 64
#: Shingles that an exact comparison lays out side by side.
WIDE = 1024

_RNG = np.random.default_rng(20_240_501)
FACTORS = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
BAND_FACTORS = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
HALF = np.uint64(32)


@dataclass
class Shingled:
    """Distinct shingles of one text, in order, and its MinHash values."""

    shingles: np.ndarray
    minhash: np.ndarray

    @property
    def key(self) -> bytes:
        return xxhash.xxh3_128_digest(self.shingles.tobytes())

    @property
    def bands(self) -> np.ndarray:
        parts = (self.minhash.astype(np.uint64) + np.uint64(1)) * BAND_FACTORS
        values = parts.reshape(BANDS, BAND_ROWS).sum(axis=1, dtype=np.uint64)
        values = (values ^ (values >> HALF)) * BAND_FACTORS[:BANDS]
        return (values ^ (values >> HALF)).view(np.int64)


def shingled(texts: list[str | None]) -> Iterator[Shingled | None]:
    """The shingles and MinHash values of each text, in order; None if it has no word."""
    for _, run in chunks(texts):
        numbers, begins = word_numbers(run)
        counts = np.diff(begins)
        grams = gram_numbers(numbers, SHINGLE_WORDS)
        sets: list[np.ndarray] = []
        for a, n in zip(begins[:-1], counts, strict=True):
            if n >= SHINGLE_WORDS:
                sets.append(np.unique(grams[a : a + n - SHINGLE_WORDS + 1]))
            elif n:
                sets.append(gram_numbers(numbers[a : a + n], int(n)) + np.uint64(n))
            else:
                sets.append(numbers[:0])
        some = [s for s in sets if len(s)]
        if some:
            flat = np.concatenate(some)
            starts = np.cumsum([0] + [len(s) for s in some[:-1]])
            least = np.empty((len(some), HASHES), np.uint32)
            for i, factor in enumerate(FACTORS):
                least[:, i] = np.minimum.reduceat((flat * factor) >> HALF, starts)
        found = iter(range(len(some)))
        for s in sets:
            yield Shingled(s, least[next(found)]) if len(s) else None


@functools.cache
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 16, 32, ... compared values, the matches below which a pair is dropped."""
    grid = np.linspace(0, 1, 200_001)[1:-1]
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(log - log.max())
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                break
        out.append(m)
    return tuple(out)


def linked_parts(
    left: list[np.ndarray], left_hash: np.ndarray, right: list[np.ndarray], right_hash: np.ndarray, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of the pairs whose similarity reaches the threshold, for some left sets at a time."""
    size_l, size_r = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    verified, table = 0, None
    for a in range(0, len(left), ROWS):
        i, j = np.indices((min(ROWS, len(left) - a), len(right)), np.int32).reshape(2, -1)
        i += a
        # Sets whose sizes alone keep them below the threshold need no look at their values.
        low, high = np.minimum(size_l[i], size_r[j]), np.maximum(size_l[i], size_r[j])
        keep = low >= SIMILARITY * high - 1e-9
        if same:
            keep &= i < j
        i, j = _probable(i[keep], j[keep], left_hash, right_hash)
        verified += len(i)
        if not len(i):
            continue
        if table is None and verified > 4 * (len(left) + len(right)):
            table = _common(left, right)
        if table is None:
            common = np.array([len(np.intersect1d(left[a], right[b], assume_unique=True)) for a, b in zip(i, j, strict=True)])
        else:
            common = table[i, j]
        union = size_l[i] + size_r[j] - common
        keep = common >= SIMILARITY * union - 1e-9
        yield i[keep], j[keep]


def linked_pairs(
    left: list[np.ndarray], left_hash: np.ndarray, right: list[np.ndarray], right_hash: np.ndarray, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """All of ``linked_parts`` together."""
    none = np.zeros(0, np.int32)
    parts = [(none, none), *linked_parts(left, left_hash, right, right_hash, same)]
    i, j = (np.concatenate(side) for side in zip(*parts, strict=True))
    return i, j


def _probable(i: np.ndarray, j: np.ndarray, left_hash: np.ndarray, right_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that more and more of their MinHash values leave probable."""
    matches = np.zeros(len(i), np.int32)
    for k, least in enumerate(least_matches(SIMILARITY, TOLERANCE)):
        if not len(i):
            break
        part = slice(k * STEP, (k + 1) * STEP)
        matches += (left_hash[i, part] == right_hash[j, part]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        if not keep.all():
            i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 matrices over the shared shingles."""
    l_all, r_all = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(l_all, r_all)
    total = np.zeros((len(left), len(right)), np.float32)
    l_row = np.repeat(np.arange(len(left)), [len(s) for s in left])
    r_row = np.repeat(np.arange(len(right)), [len(s) for s in right])
    l_col, r_col = np.searchsorted(shared, l_all), np.searchsorted(shared, r_all)
    l_col[l_col == len(shared)] = 0
    r_col[r_col == len(shared)] = 0
    l_in, r_in = shared[l_col] == l_all, shared[r_col] == r_all
    l_row, l_col, r_row, r_col = l_row[l_in], l_col[l_in], r_row[r_in], r_col[r_in]
    for a in range(0, len(shared), WIDE):
        x = np.zeros((len(left), min(WIDE, len(shared) - a)), np.float32)
        y = np.zeros((len(right), x.shape[1]), np.float32)
        pick = (l_col >= a) & (l_col < a + WIDE)
        x[l_row[pick], l_col[pick] - a] = 1
        pick = (r_col >= a) & (r_col < a + WIDE)
        y[r_row[pick], r_col[pick] - a] = 1
        total += x @ y.T
    return total


def roots(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index in the component of each node, where ``label`` are those without the
    edges (i, j)."""
    i, j = np.concatenate([i, np.arange(len(label))]), np.concatenate([j, label])
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, set_key, n_shingles and bands of each row."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("set_key", pa.binary()), ("n_shingles", pa.int32()), ("bands", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                keys, sizes, bands = [], [], []
                for s in shingled(part.column(2).to_pylist()):
                    keys.append(s and s.key)
                    sizes.append(len(s.shingles) if s else 0)
                    bands.append(s and s.bands)
                made = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, set_key binary, n_shingles int, bands array<long>")


def _members(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """block, set_id, copies, minhash and shingles of the sets in ``wanted``."""
    names = ("block", "set_id", "copies", "minhash", "shingles")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4):
                own, minhash, shingles = [], [], []
                for s, key in zip(shingled(part.column(4).to_pylist()), part.column(3).to_pylist(), strict=True):
                    # Another text may have the same 64-bit hash; its set is another one.
                    own.append(s is not None and s.key == key)
                    if own[-1]:
                        minhash.append((s.minhash & np.uint32(0xFFFF)).astype("<u2").tobytes())
                        shingles.append(s.shingles.astype("<u8").tobytes())
                plain = part.select([0, 1, 2]).filter(pa.array(own))
                columns = [*plain.columns, pa.array(minhash, pa.binary()), pa.array(shingles, pa.binary())]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names=names)

    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").where(F.col("text").isNotNull())
    joined = texts.join(wanted, "text_hash").select("block", "set_id", "copies", "set_key", "text")
    made = joined.mapInArrow(run, "block long, set_id long, copies long, minhash binary, shingles binary")
    return made.dropDuplicates(["set_id"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block pair to set_id, links and root of each set with a link in it."""

    def result(rows: list[tuple], same: bool) -> pa.RecordBatch | None:
        left = [r for r in rows if r[2] == 0]
        right = left if same else [r for r in rows if r[2] == 1]
        if not left or not right:
            return None
        unpack = lambda side: ([np.frombuffer(r[6], "<u8") for r in side], np.stack([np.frombuffer(r[5], "<u2") for r in side]))
        (a, a_hash), (b, b_hash) = unpack(left), unpack(right)
        ids = np.array([r[3] for r in left] + ([] if same else [r[3] for r in right]))
        copies = np.array([r[4] for r in left] + ([] if same else [r[4] for r in right]))
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        # A dense pair of blocks has millions of links: they are added up as they are found.
        for i, j in linked_parts(a, a_hash, b, b_hash, same):
            j = j if same else j + len(left)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            label = roots(label, i, j)
        root = ids[label]
        some = links > 0
        if not some.any():
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(links[some]), pa.array(root[some])], names=["set_id", "links", "root"]
        )

    rows: list[tuple] = []
    for row in (r for batch in batches for part in slices(batch, 6) for r in zip(*[c.to_pylist() for c in part.columns], strict=True)):
        if rows and rows[-1][:2] != row[:2]:
            if (found := result(rows, rows[0][0] == rows[0][1])) is not None:
                yield found
            rows = []
        rows.append(row)
    if rows and (found := result(rows, rows[0][0] == rows[0][1])) is not None:
        yield found


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) from edges (a, b), a not b."""
    edges = stored(edges.select("a", "b").distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a != b").distinct(), "edges")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = small


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links, n_copies and n_shingles of each row of ``docs``.

    ``n_links`` counts the other rows whose similarity reaches the threshold, and
    ``n_copies`` those among them with the same set of shingles.
    """
    return _classed(docs).drop("text_hash", "class_hash")


def _classed(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with the hash of each row's text, and of the text of the row that
    names its class: of those with the smallest doc_id the one with the smallest hash."""
    signed = stored(_signed(docs), "signed")
    one = signed.where("n_shingles > 0").groupBy("set_key").agg(
        F.count("*").alias("copies"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("first_row"),
        F.min(F.struct("text_hash", "n_shingles", "bands")).alias("own"),
    )
    sets = stored(
        one.select(F.monotonically_increasing_id().alias("set_id"), "set_key", "copies", "first_row", "own.*"), "sets"
    )
    # Buckets with more than one set, and in each set the largest of them.
    members = sets.select("set_id", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(members.join(sizes, "bucket"), "buckets")
    homes = members.groupBy("set_id").agg(F.max(F.struct("n", "bucket")).alias("home"))
    # Sets of one dense group differ in their largest bucket; they move to the largest that
    # any set has with which they share a bucket, so that the group is in few blocks.
    known = members.select("set_id", "bucket").join(homes, "set_id")
    best = known.groupBy("bucket").agg(F.max("home").alias("home"))
    homes = members.select("set_id", "bucket").join(best, "bucket").groupBy("set_id").agg(F.max("home").alias("home"))
    homes = homes.join(sets.select("set_id", "n_shingles"), "set_id")
    room = homes.groupBy("home").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("shingles"))
    slots = F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES))
    slot = F.pmod(F.xxhash64("set_id"), F.col("slots"))
    blocks = homes.join(room.select("home", slots.alias("slots")), "home")
    blocks = stored(blocks.select("set_id", F.xxhash64("home.bucket", slot).alias("block")), "blocks")
    # Pairs of blocks with a common bucket.
    spread = members.join(blocks, "set_id").select("bucket", "block").distinct()
    pairs = spread.select("bucket", F.col("block").alias("b1")).join(spread.select("bucket", F.col("block").alias("b2")), "bucket")
    pairs = pairs.where("b1 <= b2").select("b1", "b2").distinct()
    wanted = blocks.join(sets.select("set_id", "copies", "text_hash", "set_key"), "set_id")
    loaded = stored(_members(docs, wanted), "members")
    own = F.array(F.struct(F.lit(0).alias("side"), F.col("b1").alias("block")))
    other = F.array(F.struct(F.lit(0).alias("side"), F.col("b1").alias("block")), F.struct(F.lit(1).alias("side"), F.col("b2").alias("block")))
    sides = pairs.select("b1", "b2", F.explode(F.when(F.col("b1") == F.col("b2"), own).otherwise(other)).alias("s"))
    sides = sides.select("b1", "b2", "s.side", "s.block").join(loaded, "block").drop("block")
    sides = sides.select("b1", "b2", "side", "set_id", "copies", "minhash", "shingles")
    found = sides.repartition("b1", "b2").sortWithinPartitions("b1", "b2")
    found = stored(found.mapInArrow(_compare, "set_id long, links long, root long"), "links")
    links = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    rooted = components(found.where("set_id != root").select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    linked = sets.select("set_id", "set_key", "copies", "first_row").join(links, "set_id", "left")
    linked = linked.join(rooted, linked.set_id == rooted.node, "left").withColumn("root", F.coalesce("root", "set_id"))
    least = linked.groupBy("root").agg(F.min("first_row").alias("first_row"))
    by_set = linked.drop("first_row").join(least, "root").select("set_key", "copies", "first_row", F.coalesce("links", F.lit(0)).alias("links"))
    rows = signed.select("doc_id", "text_hash", "set_key", "n_shingles").join(by_set, "set_key", "left")
    return rows.select(
        "doc_id",
        F.coalesce("first_row.doc_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce(F.col("copies") - 1, F.lit(0)).alias("n_copies"),
        F.col("n_shingles").cast("long").alias("n_shingles"),
        "text_hash",
        F.coalesce("first_row.text_hash", "text_hash").alias("class_hash"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each class, the row that names it.

    Rows with the same doc_id and text are one; a row without doc_id stays.
    """
    others = _classed(docs).where("doc_id IS NOT NULL AND (doc_id != class_id OR text_hash != class_hash)")
    gone = others.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__gone_hash")).distinct()
    same = (docs["doc_id"] == F.col("__gone")) & (F.xxhash64(docs["text"]) == F.col("__gone_hash"))
    return docs.join(gone, same, "left_anti").dropDuplicates(["doc_id", "text"])
