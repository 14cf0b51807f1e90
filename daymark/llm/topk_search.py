"""Exact top-k inner products by a three-phase uniform threshold.

Vectors become whole numbers, floor(64 * x). The table is packed into packets of rows and
those into blocks, and a vector into two halves of its components: each (block, half) holds
one local list of scores per query.

1. Gather: every list gives its k highest local scores. Both lists of a block are in one
   task, so the rows they name are completed there. These sums are scores that exist, and
   the k-th highest of all blocks bounds the result from below.
2. Cut: that bound is sent back to the blocks. Divided by the number of halves it is a safe
   cutoff: a row below it in both halves cannot be in the result. Every entry at or above
   it is taken.
3. Resolve: scores of these rows are completed exactly, rows below the bound are dropped,
   each block gives its k best, and the k best of those are the result.

Queries meet all rows block by block (queries are a stated part of the table). Block and
queries come to a task as one sorted stream of packets, not by a join: so neither side, nor
the copies of it that all blocks need, can be gathered whole in one task or on the driver.
A task holds one block (``BLOCK_BYTES``) and looks at one packet of queries at a time.

Rows: vectors that are null, or that hold null or non-finite components, take no part,
neither as queries nor as candidates; nor do rows without an id. Vectors of another length
than the most common of the table are an error. Equal scores are ordered by vec_id.
A repeated vec_id counts once (of different vectors the first in order). A query's own row
is no candidate. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymark.llm.common import stored

SCALE = 64.0
HALVES = 2
K = 20
#: Rows of one packet of candidates and of one packet of queries, in expectation, and the
#: most components of either.
CANDIDATES = 4096
QUERIES = 256
PACKET_VALUES = 1 << 20
#: Most bytes of components in a block; smaller tables have up to so many blocks of whole packets.
BLOCK_BYTES = 32 << 20
BLOCKS = 32
#: Most bytes of queries that meet a block in one task; a table with fewer has up to so many
#: tasks as long as each compares so many pairs.
GROUP_BYTES = 16 << 20
TASKS = 64
PAIRS = 1 << 27
PACKET_DDL = "packet long, ids binary, rows binary, low binary"
GATHERED_DDL = "packet long, low binary"
LIST_DDL = "query_id long, vec_id long, score long"

#: ids, and components as whole numbers of the narrowest type, of the packets of a block.
Block = list[tuple[np.ndarray, np.ndarray]]


def _vectors(rows: DataFrame) -> DataFrame:
    """vec_id and whole-number components of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _packets(vectors: DataFrame, n: int, dimension: int, kind: np.dtype) -> DataFrame:
    """``n`` packets of vectors: ids and components one after the other, by id."""
    dealt = vectors.withColumn("packet", F.pmod(F.xxhash64("vec_id"), F.lit(n)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, parts = None, [], []

        def row() -> pa.RecordBatch:
            columns = [[current], [np.concatenate(ids).tobytes()], [np.concatenate(parts).tobytes()], [None]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            packets = batch.column(0).to_numpy()
            found = batch.column(1).to_numpy()
            lists = batch.column(2)
            lengths = np.diff(lists.offsets.to_numpy())
            if (lengths != dimension).any():
                raise ValueError(f"vectors of {sorted(set(lengths.tolist()))} components; {dimension} expected")
            flat = lists.flatten().to_numpy().reshape(-1, dimension).astype(kind)
            edges = np.flatnonzero(np.diff(packets)) + 1
            for a, b in zip([0, *edges], [*edges, len(packets)], strict=True):
                if current is not None and packets[a] != current:
                    yield row()
                    ids, parts = [], []
                current = int(packets[a])
                ids.append(found[a:b])
                parts.append(flat[a:b])
        if current is not None:
            yield row()

    names, types = ("packet", "ids", "rows", "low"), (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    ordered = dealt.select("packet", "vec_id", "v").repartition("packet").sortWithinPartitions("packet", "vec_id")
    return stored(ordered.mapInArrow(pack, PACKET_DDL), "vectors")


def _bytes(column: pa.Array, i: int) -> memoryview:
    return memoryview(column[i].as_buffer())


def _meet(candidates: DataFrame, queries: DataFrame, n_blocks: int, n_groups: int, dimension: int, kind: np.dtype, look: Callable, ddl: str) -> DataFrame:
    """What ``look`` makes of each block of candidates and packet of queries.

    A task gets one block and one group of queries; the packets of the block come first.
    """

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    packet = F.col("packet")
    blocks = candidates.select("*", F.lit(0).alias("side"), F.pmod(packet, F.lit(n_blocks)).cast("int").alias("block"), each(n_groups).alias("group"))
    groups = queries.select("*", F.lit(1).alias("side"), each(n_blocks).alias("block"), F.pmod(packet, F.lit(n_groups)).cast("int").alias("group"))
    both = blocks.unionByName(groups).repartitionById(n_blocks * n_groups, F.col("block") * F.lit(n_groups) + F.col("group"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = []
        for batch in batches:
            side, packet, ids, rows, low = batch.columns
            for i in range(batch.num_rows):
                found = np.frombuffer(_bytes(ids, i), np.int64), np.frombuffer(_bytes(rows, i), kind).reshape(-1, dimension)
                if side[i].as_py() == 0:
                    block.append((found[0].copy(), found[1].copy()))
                elif block:
                    yield look(block, packet[i].as_py(), *found, None if low[i].as_py() is None else np.frombuffer(_bytes(low, i)))

    return both.sortWithinPartitions("side", "packet").select("side", "packet", "ids", "rows", "low").mapInArrow(run, ddl)


def _locals(block: Block, q_ids: np.ndarray, q: np.ndarray, exact: np.dtype) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """ids of each packet of the block, and its local scores for each half; those of a
    query's own row are -inf. The arrays are used again for the next packet."""
    edge = q.shape[1] // HALVES
    parts = [slice(h * edge, (h + 1) * edge if h < HALVES - 1 else None) for h in range(HALVES)]
    q = q.astype(exact)
    room = np.empty((HALVES, len(q) * max(len(ids) for ids, _ in block)), exact)
    for ids, x in block:
        x = x.astype(exact)
        local = [room[h, : len(q) * len(x)].reshape(len(q), len(x)) for h in range(HALVES)]
        place = np.minimum(np.searchsorted(ids, q_ids), len(ids) - 1)
        own = np.flatnonzero(ids[place] == q_ids)
        for s, p in zip(local, parts, strict=True):
            np.matmul(q[:, p], x[:, p].T, out=s)
            s[own, place[own]] = -np.inf
        yield ids, local


def _places(hit: np.ndarray) -> np.ndarray:
    """Where ``hit`` is true, as flat places; most often it is nearly nowhere."""
    flat = hit.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    if len(words) * 16 > len(flat):
        return np.flatnonzero(flat)
    near = (words[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([near[flat[near]], whole + np.flatnonzero(flat[whole:])])


def _ranked(n: int, k: int, row: np.ndarray, score: np.ndarray, *ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the ``k`` highest scores of each of ``n`` rows, row by row, and where
    among them the k-th of a row is (-1: there are fewer)."""
    order = np.lexsort((*ties, -score)) if ties else np.argsort(-score)
    # Few rows: 16 bits are sorted by radix.
    order = order[np.argsort(row[order].astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")]
    row = row[order]
    starts = np.searchsorted(row, np.arange(n))
    kept = np.arange(len(row)) - starts[row] < k
    counts = np.bincount(row[kept], minlength=n)
    return order[kept], np.where(counts == k, np.cumsum(counts) - 1, -1)


class _Local:
    """The k highest local scores of each query in one list, as far as it has been read."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.floor: np.ndarray | None = None
        self.rows: list[tuple[np.ndarray, ...]] = []

    def _begin(self, s: np.ndarray) -> np.ndarray:
        """Places with at least the k highest of each query: the k-th highest of the largest
        values of parts of the list is not above the k-th highest of all."""
        n, k = s.shape[1], self.k
        parts = max(64, 2 * k)
        if n < 2 * parts:
            self.floor = np.full(len(s), -np.inf)
            return _places(s > -np.inf)
        largest = s[:, : n // parts * parts].reshape(len(s), -1, parts).max(axis=1)
        self.floor = np.partition(largest, parts - k, axis=1)[:, parts - k]
        hit = s >= self.floor[:, None]
        if np.count_nonzero(hit) > 4 * k * len(s):  # equal scores
            best = np.argpartition(s, n - k, axis=1)[:, n - k :]
            hit[:] = False
            np.put_along_axis(hit, best, True, axis=1)
        at = _places(hit)
        return at[s.ravel()[at] > -np.inf]

    def read(self, s: np.ndarray, sums: Callable[[np.ndarray], np.ndarray], first: int) -> None:
        at = self._begin(s) if self.floor is None else _places(s > self.floor[:, None].astype(s.dtype))
        self.rows.append((at // s.shape[1], s.ravel()[at], sums(at), first + at % s.shape[1]))
        if sum(len(r[0]) for r in self.rows) > 4 * self.k * self.n:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*self.rows, strict=True)]
        kept, last = _ranked(self.n, self.k, columns[0], columns[1])
        columns = [c[kept] for c in columns]
        if len(kept):
            self.floor = np.where(last >= 0, np.maximum(columns[1][last], self.floor), self.floor)
        self.rows = [tuple(columns)]
        return self.rows[0]


def _gathered(block: Block, q_ids: np.ndarray, q: np.ndarray, k: int, exact: np.dtype) -> np.ndarray:
    """Phase one in a block: for each query the ``k`` highest scores of the rows that a list
    of the block names; -inf where there are fewer."""
    lists = [_Local(len(q), k) for _ in range(HALVES)]
    first = 0
    for ids, local in _locals(block, q_ids, q, exact):
        for part, s in zip(lists, local, strict=True):
            part.read(s, lambda at, x=local: sum(y.ravel()[at] for y in x), first)
        first += len(ids)
    row, _, score, place = (np.concatenate(c) for c in zip(*[part.settle() for part in lists], strict=True))
    # A row that both lists name is one row.
    _, once = np.unique(row * first + place, return_index=True)
    row, score = row[once], score[once]
    kept, _ = _ranked(len(q), k, row, score)
    row, score = row[kept], score[kept]
    low = np.full((len(q), k), -np.inf)
    low[row, np.arange(len(row)) - np.searchsorted(row, row)] = score
    return low


def _resolved(block: Block, q_ids: np.ndarray, q: np.ndarray, low: np.ndarray, k: int, exact: np.dtype) -> tuple[np.ndarray, ...]:
    """Phases two and three in a block: query, id and score of the ``k`` best rows at or
    above the bounds."""
    rows: list[tuple[np.ndarray, ...]] = []
    floor, floor_id = low, np.full(len(q), np.iinfo(np.int64).max)
    # Half of a whole number below 2**24 (2**52 in double precision) is exact.
    cut = (low / HALVES).astype(exact)[:, None]

    def settle() -> None:
        nonlocal rows, floor, floor_id
        columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
        kept, last = _ranked(len(q), k, columns[0], columns[2], columns[1])
        rows = [tuple(c[kept] for c in columns)]
        if len(kept):
            floor = np.where(last >= 0, rows[0][2][last], floor)
            floor_id = np.where(last >= 0, rows[0][1][last], floor_id)

    for ids, local in _locals(block, q_ids, q, exact):
        sent = local[0] >= cut
        for s in local[1:]:
            sent |= s >= cut
        at = _places(sent)
        score = sum(s.ravel()[at] for s in local).astype(np.float64)
        row = at // len(ids)
        found = ids[at % len(ids)]
        keep = (score > floor[row]) | ((score == floor[row]) & (found < floor_id[row]) & (score > -np.inf))
        row, found, score = row[keep], found[keep], score[keep]
        # Of equal scores at the bound k are enough; a packet has its rows by id.
        equal = np.flatnonzero(score == floor[row])
        extra = np.arange(len(equal)) - np.searchsorted(row[equal], row[equal]) >= k
        if extra.any():
            row, found, score = (np.delete(c, equal[extra]) for c in (row, found, score))
        rows.append((row, found, score))
        if sum(len(r[0]) for r in rows) > 4 * k * len(q):
            settle()
    settle()
    return q_ids[rows[0][0]], rows[0][1], rows[0][2].astype(np.int64)


def _bounds(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Packets of queries with the k-th highest of what all blocks gathered for each; each
    packet comes before what was gathered for it."""
    names, types = ("packet", "ids", "rows", "low"), (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    current: tuple | None = None
    best = np.empty((0, k))

    def row() -> pa.RecordBatch:
        columns = [[v] for v in (*current, best.min(axis=1).tobytes())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        packet, ids, rows, low = batch.columns
        for i in range(batch.num_rows):
            if low[i].as_py() is None:
                if current is not None:
                    yield row()
                current = packet[i].as_py(), ids[i].as_py(), rows[i].as_py()
                best = np.full((len(current[1]) // 8, k), -np.inf)
            else:
                both = np.concatenate([best, np.frombuffer(_bytes(low, i)).reshape(-1, k)], axis=1)
                best = np.partition(both, k, axis=1)[:, k:]
    if current is not None:
        yield row()


def top_k(rows: DataFrame, *, k: int = K, query_step: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows for each query.

    Queries are the rows whose id is divisible by ``query_step``.
    """
    spark = rows.sparkSession
    vectors = stored(_vectors(rows), "vectors")
    is_query = F.pmod("vec_id", F.lit(query_step)) == 0
    facts = vectors.agg(
        F.mode(F.size("v")).alias("dimension"),
        F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("largest"),
        F.count("*").alias("rows"),
        F.count_if(is_query).alias("queries"),
    ).first()
    if facts["dimension"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dimension, largest = facts["dimension"], float(facts["largest"])
    if dimension * largest * largest >= 2.0**52:
        raise ValueError("components too large for exact sums")
    # Sums of products are whole numbers, exact up to 2**24 in single and 2**53 in double precision.
    exact = np.dtype(np.float32 if dimension * largest * largest < 2.0**24 else np.float64)
    kind = next(np.dtype(t) for t in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max)
    n_packets = max(1, -(-facts["rows"] // max(1, min(CANDIDATES, PACKET_VALUES // dimension))))
    n_query_packets = max(1, -(-facts["queries"] // max(1, min(QUERIES, PACKET_VALUES // dimension))))
    width = dimension * kind.itemsize
    n_blocks = min(n_packets, max(BLOCKS, -(-facts["rows"] * width // BLOCK_BYTES)))
    pairs = facts["rows"] * facts["queries"] // n_blocks
    n_groups = min(n_query_packets, max(1, -(-facts["queries"] * width // GROUP_BYTES), min(TASKS // n_blocks, pairs // PAIRS)))
    candidates = _packets(vectors, n_packets, dimension, kind)
    queries = _packets(vectors.where(is_query), n_query_packets, dimension, kind)

    def gather(block: Block, packet: int, q_ids: np.ndarray, q: np.ndarray, low: None) -> pa.RecordBatch:
        found = _gathered(block, q_ids, q, k, exact).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([packet], pa.int64()), pa.array([found], pa.binary())], names=["packet", "low"])

    def resolve(block: Block, packet: int, q_ids: np.ndarray, q: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        found = _resolved(block, q_ids, q, low, k, exact)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    met = _meet(candidates, queries, n_blocks, n_groups, dimension, kind, gather, GATHERED_DDL)
    lists = queries.unionByName(met, allowMissingColumns=True).repartition("packet")
    lists = lists.sortWithinPartitions("packet", F.col("low").isNotNull())
    bounded = stored(lists.mapInArrow(lambda batches: _bounds(batches, k), PACKET_DDL), "bounds")
    entries = _meet(candidates, bounded, n_blocks, n_groups, dimension, kind, resolve, LIST_DDL)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return entries.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
