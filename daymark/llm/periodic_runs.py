"""Periodic runs of words: stretches that repeat with a period at least ``REPEATS`` times.

A run is a stretch with smallest period q, of at least ``max(LEAST_WORDS, REPEATS * q)`` words,
that no neighbouring word extends. Every run contains a Lyndon root: a period of it is the
longest Lyndon word that begins at its place, in the order of words or in the reverse order.
So each place gives two candidates, and each candidate is extended in both directions by
longest common extensions. These are string depths of lowest common ancestors in suffix trees
(by Ukkonen's construction) of the words and of their reversal, read in constant time from a
Euler tour with range minima over blocks.

Only words that can be in a run reach the trees. Every five consecutive words inside a run
occur again at a distance of its period, so of at most a quarter of its length; the words of
a text that no such five words cover are in no run, and separate the pieces that are left. Five
words are compared by a hash, which can keep words too many, never too few; the trees compare
exact words. Short pieces share a tree, with a symbol of its own between two pieces. Memory of
a task grows with its longest piece, by about 600 bytes a word, and with nothing else.

Null texts have no words. Empty texts have no runs. Very long texts are searched whole. Repeated
rows are searched one by one. Runs are ordered by start, then period; ties of the strongest run
go to the smallest start, then period. An empty table gives no rows. Columns of the documents
are kept, but for those whose names are taken by the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from daymark.llm.common import WORD, chunks, mixed, without

LEAST_WORDS = 6
REPEATS = 4
#: Consecutive words that have to occur again; a run of LEAST_WORDS holds two such windows.
WINDOW = LEAST_WORDS - 1
#: Words of short pieces that share a tree.
TREE_WORDS = 1 << 14
_BLOCK = 16

Run = tuple[int, int, int]
_RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
_FOUND = T.StructType().add("runs", T.ArrayType(_RUN)).add("n_words", "long").add("collapsed", "string")


class SuffixTree:
    """The suffix tree of numbers whose last one occurs nowhere else, with its Euler tour.

    ``orders`` are maps of the symbols; for each, ``ranks`` has the place of every suffix in
    the order of the mapped symbols.
    """

    def __init__(self, symbols: list[int], orders: list[np.ndarray]) -> None:
        self.n = len(symbols)
        start, end, edges = _ukkonen(symbols)
        count = len(start)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        child = np.fromiter(edges.values(), np.int64, len(edges))
        del edges
        parent, symbol = keys >> 32, keys & 0xFFFFFFFF
        begins, ends = np.array(start, np.int64), np.array(end, np.int64)
        self.ranks = []
        for order in orders:
            sorting = np.lexsort((order[symbol], parent))
            first = np.searchsorted(parent[sorting], np.arange(count + 1)).tolist()
            children = child[sorting].tolist()
            leaves, depths, places = _tour(first, children, (ends - begins).tolist(), self.n)
            rank = np.empty(self.n, np.int64)
            rank[leaves] = np.arange(self.n)
            self.ranks.append(rank)
        # Any tour serves the common extensions; the last one is taken.
        self.at = np.empty(self.n, np.int64)
        self.at[leaves] = places
        self._minima(np.array(depths, np.int32))

    def _minima(self, depths: np.ndarray) -> None:
        blocks = -(-len(depths) // _BLOCK)
        tour = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        tour[: len(depths)] = depths
        cut = tour.reshape(blocks, _BLOCK)
        self.tour = tour
        self.from_left = np.minimum.accumulate(cut, axis=1).ravel()
        self.to_right = np.minimum.accumulate(cut[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [cut.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common beginnings of the suffixes at i and at j, i != j."""
        left, right = np.minimum(self.at[i], self.at[j]), np.maximum(self.at[i], self.at[j])
        a, b = left // _BLOCK, right // _BLOCK
        found = np.minimum(self.to_right[left], self.from_left[right])
        inside = np.flatnonzero(a == b)
        if len(inside):
            lo, hi = left[inside], right[inside]
            low = self.tour[lo]
            for k in range(1, _BLOCK):
                low = np.minimum(low, self.tour[np.minimum(lo + k, hi)])
            found[inside] = low
        apart = np.flatnonzero(b - a > 1)
        if len(apart):
            lo, size = a[apart] + 1, b[apart] - a[apart] - 1
            level = np.frexp(size)[1] - 1
            low = np.empty(len(apart), np.int32)
            for k in np.unique(level):
                rows = np.flatnonzero(level == k)
                minima = self.levels[k]
                low[rows] = np.minimum(minima[lo[rows]], minima[lo[rows] + size[rows] - (1 << int(k))])
            found[apart] = np.minimum(found[apart], low)
        return found.astype(np.int64)


def _ukkonen(s: list[int]) -> tuple[list[int], list[int], dict[int, int]]:
    """Edges of the suffix tree of ``s``: where the edge into each node begins and ends, and
    the node behind each pair of node and first symbol. Node 0 is the root."""
    n = len(s)
    start, end, link = [0], [0], [0]
    edges: dict[int, int] = {}
    node = edge = length = waiting = 0
    for i, c in enumerate(s):
        waiting += 1
        fresh = 0
        while waiting:
            if not length:
                edge = i
            key = (node << 32) | s[edge]
            below = edges.get(key)
            if below is None:
                edges[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                first = start[below]
                last = end[below]
                size = (last if last <= i else i + 1) - first
                if length >= size:
                    edge += size
                    length -= size
                    node = below
                    continue
                if s[first + length] == c:
                    if fresh:
                        link[fresh] = node
                    length += 1
                    break
                split = len(start)
                edges[key] = split
                edges[(split << 32) | c] = split + 1
                edges[(split << 32) | s[first + length]] = below
                start += (first, i)
                end += (first + length, n)
                link += (0, 0)
                start[below] = first + length
                if fresh:
                    link[fresh] = split
                fresh = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return start, end, edges


def _tour(first: list[int], children: list[int], edge: list[int], n: int) -> tuple[list[int], list[int], list[int]]:
    """Suffixes of the leaves in order, string depths along the Euler tour, and the place of
    each leaf in it."""
    leaves: list[int] = []
    places: list[int] = []
    depths = [0]
    path, depth, nexts = [0], [0], [first[0]]
    while path:
        at = nexts[-1]
        if at == first[path[-1] + 1]:
            path.pop()
            depth.pop()
            nexts.pop()
            if depth:
                depths.append(depth[-1])
            continue
        nexts[-1] = at + 1
        below = children[at]
        deep = depth[-1] + edge[below]
        if first[below] == first[below + 1]:
            leaves.append(n - deep)
            places.append(len(depths))
            depths += (deep, depth[-1])
        else:
            depths.append(deep)
            path.append(below)
            depth.append(deep)
            nexts.append(first[below])
    return leaves, depths, places


def _lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word from each place ends: at the next smaller suffix."""
    order = rank.tolist()
    ends = [len(order)] * len(order)
    open_places: list[int] = []
    for i, r in enumerate(order):
        while open_places and order[open_places[-1]] > r:
            ends[open_places.pop()] = i
        open_places.append(i)
    return np.array(ends, np.int64)


def runs_of_pieces(pieces: list[list[bytes]], least: int = LEAST_WORDS, repeats: int = REPEATS) -> list[list[Run]]:
    """The runs (start, length, period) of each piece, from one tree and one of the reversal."""
    # Numbers below ``marks`` separate, and none occurs twice; equal words have equal numbers.
    marks = len(pieces) + 1
    number: dict[bytes, int] = {}
    symbols, begins = [0], []
    for k, piece in enumerate(pieces):
        begins.append(len(symbols))
        symbols += [number.setdefault(word, marks + len(number)) for word in piece]
        symbols.append(k + 1)
    n = len(symbols)
    rising = np.arange(marks + len(number))
    falling = np.where(rising < marks, rising, rising[::-1] + marks)
    ahead = SuffixTree(symbols, [rising, falling])
    back = SuffixTree(symbols[::-1], [rising])
    text = np.array(symbols)
    found = set()
    for rank in ahead.ranks:
        ends = _lyndon_ends(rank)
        at = np.flatnonzero((text >= marks) & (ends < n))
        period = ends[at] - at
        right = ahead.common(at, at + period)
        # The words before both: in the reversal, what follows them.
        left = back.common(n - at, n - at - period)
        length = left + period + right
        strong = length >= np.maximum(least, repeats * period)
        found.update(zip((at - left)[strong].tolist(), length[strong].tolist(), period[strong].tolist(), strict=True))
    of_piece: list[list[Run]] = [[] for _ in pieces]
    for start, length, period in sorted(found, key=lambda r: (r[0], r[2])):
        k = int(np.searchsorted(begins, start, "right")) - 1
        of_piece[k].append((start - begins[k], length, period))
    return of_piece


def candidate_pieces(hashes: np.ndarray, borders: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (first, end) of words that may be in runs, for texts between ``borders``."""
    n = len(hashes)
    size = n - WINDOW + 1
    if size < 2:
        return []
    text_of = np.searchsorted(borders, np.arange(n), "right").astype(np.uint64)
    grams = np.zeros(size, np.uint64)
    for k in range(WINDOW):
        grams = mixed(grams + hashes[k : k + size])
    grams = mixed(grams ^ (text_of[:size] * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(grams, kind="stable")
    step = np.where(np.diff(grams[order].view(np.int64)) == 0, np.diff(order), n)
    near = np.full(size, n)
    near[order[:-1]] = step
    near[order[1:]] = np.minimum(near[order[1:]], step)
    crossing = text_of[WINDOW - 1 :] != text_of[:size]
    near[crossing] = n
    # Pieces shrink until every one is covered by windows that recur within a quarter of it.
    starts = np.flatnonzero(near < n)
    alive = starts
    while len(alive):
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, alive, 1)
        np.add.at(cover, alive + WINDOW, -1)
        inside = np.cumsum(cover[:n]) > 0
        cut = np.flatnonzero(np.diff(text_of.view(np.int64))) + 1
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # Neighbouring texts do not share a piece.
        cut = cut[inside[cut] & inside[cut - 1]]
        first, end = np.sort(np.concatenate([first, cut])), np.sort(np.concatenate([end, cut]))
        of = np.searchsorted(first, alive, "right") - 1
        length = (end - first)[of]
        left = alive[REPEATS * near[alive] <= length]
        if len(left) == len(alive):
            return list(zip(first.tolist(), end.tolist(), strict=True))
        alive = left
    return []


def runs_of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each list of words."""
    found: list[list[Run]] = [[] for _ in texts]
    borders = np.cumsum([len(words) for words in texts])
    if not len(borders) or not borders[-1]:
        return found
    hashes = np.fromiter((hash(word) for words in texts for word in words), np.int64, int(borders[-1])).view(np.uint64)
    waiting: list[tuple[int, int, list[bytes]]] = []

    def search() -> None:
        for (i, first, _), runs in zip(waiting, runs_of_pieces([p for _, _, p in waiting]), strict=True):
            found[i] += [(first + start, length, period) for start, length, period in runs]
        waiting.clear()

    size = 0
    for first, end in candidate_pieces(hashes, borders):
        i = int(np.searchsorted(borders, first, "right"))
        offset = int(borders[i]) - len(texts[i])
        if waiting and size + end - first > TREE_WORDS:
            search()
            size = 0
        waiting.append((i, first - offset, texts[i][first - offset : end - offset]))
        size += end - first
    if waiting:
        search()
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside runs, and of every run its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return list(compress(words, (np.cumsum(cover[:-1]) == 0).tolist()))


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with runs (start, length, period in words), n_words, and the text collapsed to
    one period per run, with one blank between words."""
    docs = without(docs.withColumn("__text_of_row", F.col(f"`{text}`").cast("string")), _FOUND.names)
    own = docs.drop("__text_of_row")
    schema = T.StructType(own.schema.fields + _FOUND.fields)
    types = to_arrow_schema(_FOUND).types

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            # One piece of about a megabyte of text after the other, so that little is alive at once.
            for first, run in chunks(batch.column(last).to_pylist()):
                texts = [data.split() for data in run]
                found = runs_of_texts(texts)
                made = [
                    [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found],
                    [len(words) for words in texts],
                    [b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass") for words, runs in zip(texts, found, strict=True)],
                ]
                kept = [batch.column(i).slice(first, len(run)) for i in range(last)]
                yield pa.RecordBatch.from_arrays(kept + [pa.array(c, t) for c, t in zip(made, types, strict=True)], names=schema.names)

    return docs.mapInArrow(search, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest ratio of length and period; null if there is none."""

    def order(a: Column, b: Column) -> Column:
        more = a["length"] * b["period"] - b["length"] * a["period"]
        steps = [(more, -1), (a["start"] - b["start"], 1), (a["period"] - b["period"], 1)]
        found = F.lit(0)
        for value, sign in reversed(steps):
            found = F.when(value > 0, F.lit(sign)).when(value < 0, F.lit(-sign)).otherwise(found)
        return found

    return F.get(F.array_sort(runs, order), F.lit(0))


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of all runs and of the collapsed text."""
    rows = with_runs(docs.select("doc_id", "text")).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by a hash of its id) goes on repeating
    words from a place of its own: test rows with long periods at every scale."""
    h = F.crc32(F.col("doc_id").cast("string"))
    ten, g = F.pmod(h, F.lit(10)) == 0, F.floor(h / 10).cast("long")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("__words", F.when(ten, F.regexp_extract_all("text", F.lit(WORD), 0)))
    n = F.size("__words")
    rows = rows.withColumn("__a", F.when(n > 0, F.pmod(g, n).cast("int")))
    period = 1 + F.expr("CAST((size(__words) - __a) div (3 + pmod(CAST(floor(crc32(CAST(doc_id AS STRING)) / 10) AS BIGINT), 8)) AS INT)")
    rows = rows.withColumn("__p", period)
    tail = F.transform(F.sequence(F.col("__a"), n - 1), lambda i: F.get("__words", F.col("__a") + F.pmod(i - F.col("__a"), F.col("__p"))))
    text = F.array_join(F.concat(F.slice("__words", F.lit(1), F.col("__a")), tail), " ")
    return rows.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))
