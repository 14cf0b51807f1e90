"""Source divergence audit: how differently the sources of a language use its terms.

Occurrences are counted per language, source and term, and every count becomes a smoothed
integer share. Two sources differ by ``f(p, q) = (p - q)**2 div (p + q)``, summed over all
kept terms of their language. Most terms are missing from most sources, so the sum of a pair
is taken apart, with ``0`` for the share of a term that the source never uses:

* all terms as if missing from both: ``V * f(a0, b0)``;
* a term that one source uses: ``f(p, b0) - f(a0, b0)``, once per distinct share of a source;
* a term that both use: ``f(p, q) - f(p, b0) - f(a0, q) + f(a0, b0)``, from a frequent-pattern
  tree. The row of a term is the path of its sources in order, each with its share; equal
  paths are one row with a multiplicity, rows that begin alike share nodes, and the correction
  of a node and one of its ancestors is computed once and weighted by the count of the node.

All of it is exact integer arithmetic. Trees are built per task over a range of sorted paths,
since corrections add up; a tree that outgrows ``MOST_NODES`` is added up and begun anew.

Null texts, languages and sources are ``''``. Empty texts make their group, without terms;
very long texts are only counted. Repeated rows count as often as they are there. Ties of a
value go by the item in UTF-8 order. An empty table gives no rows. Columns other than the
three named are not read, so their names cannot clash. Counts of a language up to 9 * 10**18
are exact; beyond, the sum fails instead of wrapping.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from daymark.llm.common import stored

#: Documents of a language that a term must be in.
LEAST_DOCUMENTS = 10
#: Terms reported per group.
TOP_TERMS = 10
#: Entries of the counts of a task, and nodes of its tree, before they are given away.
MOST_COUNTS = 1 << 18
MOST_NODES = 1 << 18

# ASCII letters to lower case, other ASCII characters to blanks, all other bytes unchanged.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTED = StructType().add("lang", "string").add("source", "string").add("term", "string").add("n", "long").add("docs", "long")
_PAIRS = StructType().add("lang", "string").add("source", "string").add("other", "string").add("value", "long")


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, with A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(_COUNTED)
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def drained() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in groups.items():
            for first in range(0, len(counts), 1 << 16):
                part = list(counts)[first : first + (1 << 16)]
                columns = [
                    [lang] * len(part),
                    [source] * len(part),
                    [t.decode("utf-8", "surrogatepass") for t in part],
                    [counts[t] for t in part],
                    [docs[t] for t in part],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        groups.clear()

    entries = 0
    for batch in batches:
        for lang, source, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (lang, source) not in groups:
                # The empty term, which no text holds, tells that the group is there.
                groups[lang, source] = Counter({b"": 0}), Counter()
            counts, docs = groups[lang, source]
            before, found = len(counts), terms_of(text)
            counts.update(found)
            docs.update(set(found))
            entries += len(counts) - before
            if entries > MOST_COUNTS:
                yield from drained()
                entries = 0
    yield from drained()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs; ``term`` '' stands for the group itself."""
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = filled.mapInArrow(_count, _COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, size: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / size), exactly."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(1_000_000_000)
    return F.call_function("div", wide, size.cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class _Tree:
    """A frequent-pattern tree of paths; a node is its parent, a source and a share."""

    def __init__(self) -> None:
        self.children: dict[tuple[int, int, int], int] = {}
        self.parent: list[int] = []
        self.source: list[int] = []
        self.share: list[int] = []
        self.missing: list[int] = []
        self.count: list[int] = []

    def insert(self, path: list[tuple[int, int, int]], times: int) -> int:
        """Count a path, and return how many nodes it has added."""
        at, before = -1, len(self.parent)
        for source, p, p0 in path:
            node = self.children.setdefault((at, source, p), len(self.parent))
            if node == len(self.parent):
                self.parent.append(at)
                self.source.append(source)
                self.share.append(p)
                self.missing.append(p0)
                self.count.append(0)
            self.count[node] += times
            at = node
        return len(self.parent) - before

    def corrections(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Sources of the upper and of the lower nodes, and the corrections of their pairs.

        Step k pairs every node with the ancestor k levels above it; a node that has none
        drops out, so there are as many steps as the deepest path has levels.
        """
        parent, source, p, p0, count = (np.array(x, np.int64) for x in (self.parent, self.source, self.share, self.missing, self.count))

        def f(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return (x - y) ** 2 // (x + y)

        node, up = np.arange(len(parent)), parent
        while True:
            inside = up >= 0
            node, up = node[inside], up[inside]
            if not len(node):
                return
            q, q0 = p[up], p0[up]
            value = f(p[node], q) - f(p[node], q0) - f(p0[node], q) + f(p0[node], q0)
            # One sum per pair of sources.
            key, place = np.unique((source[up] << 32) | source[node], return_inverse=True)
            sums = np.zeros(len(key), np.int64)
            np.add.at(sums, place, value * count[node])
            yield key >> 32, key & 0xFFFFFFFF, sums
            up = parent[up]


def _tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the pairs of sources, from trees over the paths of one task."""
    schema = to_arrow_schema(_PAIRS)
    trees: dict[str, _Tree] = {}
    names: dict[str, int] = {}
    nodes = 0

    def drained() -> Iterator[pa.RecordBatch]:
        of = list(names)
        for lang, tree in trees.items():
            for upper, lower, sums in tree.corrections():
                columns = [[lang] * len(sums), [of[i] for i in upper], [of[i] for i in lower], sums]
                yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, schema, strict=True)], schema=schema)
        trees.clear()
        names.clear()

    for batch in batches:
        for lang, path, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            tree = trees.setdefault(lang, _Tree())
            nodes += tree.insert([(names.setdefault(x["source"], len(names)), x["p"], x["p0"]) for x in path], times)
            if nodes > MOST_NODES:
                yield from drained()
                nodes = 0
    yield from drained()


def path_corrections(paths: DataFrame) -> DataFrame:
    """lang, source, other, value: corrections for terms that both sources use.

    ``paths`` has lang, path (source, p, p0 in source order) and times. Sorted ranges of
    paths share as many nodes as one tree of all would, but for the borders of tasks.
    """
    dealt = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return dealt.mapInArrow(_tree_pairs, _PAIRS)


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources of each group by how far they
    are from it (``pair``), and the terms it uses most above its language (``term``)."""
    counts = stored(term_counts(docs), "term-counts")
    used = counts.where(F.col("term") != "")
    kept = used.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang")).where(F.col("docs") >= least_documents)
    uses = used.drop("docs").join(kept.drop("docs"), ["lang", "term"])
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("of_lang").alias("lang_n"))
    sizes = uses.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    zero = F.lit(0).cast("long")
    groups = (
        counts.where(F.col("term") == "")
        .select("lang", "source")
        .join(langs, "lang", "left")
        .join(sizes, ["lang", "source"], "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("v", "lang_n", "group_n")])
        .withColumn("group_size", F.col("group_n") + 2 * F.col("v"))
        .withColumn("lang_size", F.col("lang_n") + 2 * F.col("v"))
        # Without kept terms there is nothing to share.
        .withColumn("p0", F.when(F.col("v") > 0, share(zero, F.col("group_size"))))
    )
    groups = stored(groups, "term-groups")
    shares = uses.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "p0",
        share(F.col("n"), F.col("group_size")).alias("p"),
        share(F.col("of_lang"), F.col("lang_size")).alias("q"),
    )
    shares = stored(shares, "term-shares")
    parts = [_pairs(shares, groups), _terms(shares, top)]
    return parts[0].unionByName(parts[1])


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with its sum over all kept terms."""
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    base = gap(F.col("p0"), F.col("q0"))
    differ = F.col("source") != F.col("other")
    none = groups.join(other, "lang").where(differ).select("lang", "source", "other", F.coalesce(F.col("v") * base, F.lit(0)).alias("value"))
    distinct = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    alone = distinct.join(other, "lang").where(differ)
    alone = alone.select("lang", "source", "other", (F.col("times") * (gap(F.col("p"), F.col("q0")) - base)).alias("value"))
    path = F.array_sort(F.collect_list(F.struct("source", "p", "p0")))
    paths = shares.groupBy("lang", "term").agg(path.alias("path")).groupBy("lang", "path").agg(F.count("*").alias("times"))
    both = path_corrections(paths.where(F.size("path") > 1))

    def total(rows: DataFrame) -> DataFrame:
        return rows.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))

    # Alone and both are corrections of a pair, seen from one side; the pair is the same from the other.
    one_sided = total(total(alone).unionByName(total(both)))
    mirrored = one_sided.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    sums = total(none.unionByName(one_sided).unionByName(mirrored))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    return sums.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", F.row_number().over(order).alias("rank"))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """The kept terms of a group with the largest gap above the share in its language."""
    above = shares.where(F.col("p") > F.col("q")).withColumn("value", gap(F.col("p"), F.col("q")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS ts
    FROM documents
),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS m FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, k.m, coalesce(n, 0) AS n FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sized AS (
    SELECT *, sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source) AS size,
           sum(m) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source) AS lang_size
    FROM grid
),
shares AS (
    SELECT lang, source, term, n, CAST(1 + 1000000000 * (n::HUGEINT + 2) // size AS HUGEINT) AS p,
           CAST(1 + 1000000000 * (m::HUGEINT + 2) // lang_size AS HUGEINT) AS q
    FROM sized
),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
