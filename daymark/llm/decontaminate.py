"""Benchmark decontamination with SimHash windows; DataFrame functions only.

A window is a run of as many words of a document as a benchmark item has. It leaks the item
if the weighted Jaccard similarity of their five-word shingles (a shingle weighs as often as
it occurs) is at least 0.8. Words stand between white space and are compared unchanged.

1. Anchors: only a window that has a shingle in common with an item can reach the
   threshold, so windows are placed where a document's shingle occurs in an item, at the
   start that this implies, and at all starts between two such starts that are close.
2. Fingerprints: windows and items get 64-bit SimHashes of their shingles.
3. Multi-index: a fingerprint is cut into eight blocks. Two that differ in at most 23 bits
   differ in at most two bits of some block, so items are listed under all block values
   within two bits, and an equality join on (size, block, value) finds every pair within
   the radius. At the threshold a pair differs in 10 bits on average; 23 lie more than four
   standard deviations beyond.
4. Pairs within the radius are verified exactly, on the words themselves.

Rows: null and empty texts, texts of fewer than five words, and items of fewer than five
words have no shingle and no leak. A document shorter than an item is one window. Repeated
rows (same doc_id and text) give one result row; repeated items give one each. A null
doc_id is kept as null, a null item_id too. Empty tables give no rows. Other columns, also
ones named like those used here, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymark.llm.common import SHINGLE_WORDS, SIMILARITY, stored

BITS = 64
BLOCKS = 8
BLOCK_BITS = BITS // BLOCKS
RADIUS = 23
#: Benchmark shingles up to this number are sent to all tasks (some 10 MB); more are joined
#: by a shuffle.
MOST_SENT = 200_000
#: Two implied starts this share of an item apart belong to one edited passage.
DRIFT = 0.15


def words_of(text: Column) -> Column:
    """The words of a text; one empty word if it has none."""
    return F.split(F.btrim(text, F.lit(" \t\n\u000b\f\r")), r"[\x20\x09-\x0D]+")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def shingle_hashes(words: Column) -> Column:
    """A 64-bit number for each run of five words; null below five words."""

    def runs(numbers: Column) -> Column:
        last = F.size(numbers) - SHINGLE_WORDS
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(numbers, i + k) for k in range(SHINGLE_WORDS)]))
        return F.when(last >= 0, each)

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def simhash(hashes: Column) -> Column:
    """Bit by bit what most shingles have, each as often as it occurs."""

    def fold(all_hashes: Column) -> Column:
        vote = lambda b: lambda a, x: a + F.when(F.call_function("shiftright", x, b).bitwiseAND(1) == 1, 1).otherwise(-1)
        votes = F.transform(F.sequence(F.lit(BITS - 1), F.lit(0)), lambda b: F.aggregate(all_hashes, F.lit(0), vote(b)))
        bit = lambda v: F.when(v > 0, 1).otherwise(0).cast("long")
        return F.aggregate(votes, F.lit(0).cast("long"), lambda a, v: F.shiftleft(a, 1).bitwiseOR(bit(v)))

    return let(hashes, fold)


def blocks_of(fingerprint: str) -> Column:
    return F.array(
        *[
            F.struct(F.lit(b).alias("block"), F.shiftright(F.col(fingerprint), b * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1).alias("value"))
            for b in range(BLOCKS)
        ]
    )


def flips(most: int = RADIUS // BLOCKS) -> list[int]:
    """All changes of up to ``most`` bits of a block."""
    return [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(BLOCK_BITS), n)]


def spelled(words: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - SHINGLE_WORDS + 1),
        lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(SHINGLE_WORDS))),
    )


def weighted_jaccard(left: Column, right: Column) -> Column:
    """Similarity of two lists of shingles in which a shingle may occur several times."""

    def compare(s: Column) -> Column:
        a, b = s["a"], s["b"]
        times = lambda side, x: F.size(F.filter(side, lambda y: y == x))
        common = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x)))
        return let(common, lambda c: c / (F.size(a) + F.size(b) - c))

    return let(F.struct(left.alias("a"), right.alias("b")), compare)


def _items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("item_words"))
    items = items.where(F.size("item_words") >= SHINGLE_WORDS).withColumn("n_words", F.size("item_words"))
    items = items.withColumn("hashes", shingle_hashes(F.col("item_words")))
    return items.withColumn("item_print", simhash(F.col("hashes")))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, start, n_words, similarity, distance of each leaked item.

    One row per document and item: of the windows placed on it the most similar, then the
    first. (Another start may be as similar where an end of the item is missing.)
    ``start`` and ``n_words`` count words, ``distance`` differing bits of the fingerprints.
    """
    items = stored(_items(benchmark), "items")
    anchors = items.select("n_words", F.posexplode("hashes").alias("item_at", "hash"))
    anchors = anchors.groupBy("hash", "n_words", "item_at").agg(F.lit(1).alias("one")).drop("one")
    n_anchors = anchors.count()

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    rows = texts.select("doc_id", "text_hash", shingle_hashes(F.col("words")).alias("hashes"))
    size = F.size("hashes") + SHINGLE_WORDS - 1
    spots = rows.select("doc_id", "text_hash", size.alias("size"), F.posexplode("hashes").alias("at", "hash"))
    side = F.broadcast(anchors) if n_anchors <= MOST_SENT else anchors
    length = F.least("n_words", "size")
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("item_at"), F.col("size") - length))
    starts = spots.join(side, "hash").select("doc_id", "text_hash", "n_words", length.alias("length"), start.alias("start")).distinct()
    after = F.lead("start").over(W.partitionBy("doc_id", "text_hash", "n_words").orderBy("start"))
    close = after - F.col("start") <= F.ceil(F.col("n_words") * DRIFT)
    starts = starts.withColumn("until", F.when(close, after - 1).otherwise(F.col("start")))
    # Written first, so that its size is known when texts are joined to it.
    per_text = starts.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("n_words", "length", "start", "until")).alias("places"))
    per_text = stored(per_text, "windows")

    again = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), "text")
    found = again.join(per_text, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")))
    found = found.select("doc_id", "text_hash", words_of(F.col("text")).alias("words"), F.explode("places").alias("p"))
    found = found.select("doc_id", "text_hash", "words", "p.n_words", "p.length", F.explode(F.sequence("p.start", "p.until")).alias("start"))
    windows = found.withColumn("window", F.slice("words", F.col("start") + 1, F.col("length"))).drop("words")
    windows = stored(windows.withColumn("print", simhash(shingle_hashes(F.col("window")))).distinct(), "windows")

    keys = items.select("item_id", "item_print", "item_words", "n_words", F.explode(blocks_of("item_print")).alias("b"))
    keys = keys.select("item_id", "item_print", "item_words", "n_words", "b.block", "b.value", F.explode(F.array(*[F.lit(f) for f in flips()])).alias("flip"))
    keys = keys.withColumn("value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")
    probes = windows.select("*", F.explode(blocks_of("print")).alias("b")).select("*", "b.block", "b.value").drop("b")
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    pairs = probes.join(keys, ["n_words", "block", "value"]).withColumn("distance", distance).where(F.col("distance") <= RADIUS)
    pairs = pairs.select("doc_id", "text_hash", "item_id", "start", "length", "window", "item_words", "distance").distinct()
    pairs = pairs.withColumn("similarity", weighted_jaccard(spelled(F.col("window")), spelled(F.col("item_words"))))
    best = F.max_by(F.struct("start", "length", "similarity", "distance"), F.struct("similarity", -F.col("start")))
    found = pairs.where(F.col("similarity") >= SIMILARITY).groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best"))
    return found.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.col("best.start").cast("long").alias("start"),
        F.col("best.length").cast("long").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
        F.col("best.distance").cast("long").alias("distance"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak a benchmark item; all else as it is."""
    leaked = stored(leaks(docs, benchmark).select("doc_id", "text_hash").distinct(), "leaked")
    leaked = leaked.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"))
    same = docs["doc_id"].eqNullSafe(F.col("__doc")) & (F.xxhash64(docs["text"]) == F.col("__hash"))
    return docs.join(leaked, same, "left_anti")
