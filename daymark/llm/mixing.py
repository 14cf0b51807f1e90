"""Mixing sources to target weights by temperature; DataFrame functions only.

Each source's share of all tokens (words between white space) is raised to one exponent and
normalised. The exponent is found by bisection: the largest one whose weights reach the
target entropy, or, if no entropy is asked for, the smallest one for which no source is
shown more often than the repetition limit. A budget of tokens is then dealt out by these
weights. By default it is the smallest budget that shows every document at least once.

A source gets whole passes over its documents and one partial pass. For a partial pass the
source is cut into 4096 blocks by a hash of the doc_id; blocks are taken in the order of a
hash of seed, source and block until the budget is met, and in the block on the border the
documents are taken in the order of such a hash. A document is taken if the tokens before
it are below the budget. The places of documents in each pass follow the same permutation.

Only sums per source (with a checked bound on the number of sources) and per block are ever
brought together; rows of a hot source are summed by block and stay spread.

Rows: a null source is a source of its own. Null and empty texts have no tokens, but a place
in the order like others. A null doc_id hashes like an empty one. Repeated rows are
rows like others. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymark.llm.common import WORD, stored

STEPS = 60
#: Sources beyond this number are refused; they meet in one row.
MOST_SOURCES = 100_000
#: Hexadecimal digits of the hash that make up a block's number: 4096 blocks.
DIGITS = 3
REPEATS = 1.5


def _hash(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts]))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens, doc_hash and block of each row."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), tokens.alias("n_tokens"), F.md5(key).alias("doc_hash"))
    return rows.withColumn("block", F.substring("doc_hash", 1, DIGITS))


def weights(
    totals: DataFrame,
    *,
    entropy: float | None = None,
    repeats: float = REPEATS,
    budget: int | None = None,
) -> DataFrame:
    """source, tokens, exponent, weight and budget from totals (source, tokens).

    ``entropy`` is a share of the largest possible one, that of equal weights. Sources
    without a token get weight 0.
    """
    one = totals.agg(F.sort_array(F.collect_list(F.struct("source", "tokens"))).alias("s"))
    too_many = F.raise_error(F.lit(f"more than {MOST_SOURCES} sources"))
    one = one.select(F.when(F.size("s") > MOST_SOURCES, too_many).otherwise(F.col("s")).alias("s"))
    one = one.select("s", F.transform(F.filter("s", lambda x: x["tokens"] > 0), lambda x: x["tokens"].cast("double")).alias("t"))
    one = one.withColumn("all", F.aggregate("t", F.lit(0.0), lambda a, x: a + x))
    one = one.withColumn("p", F.transform("t", lambda x: x / F.col("all")))
    lifted = lambda e: F.aggregate(F.col("p"), F.lit(0.0), lambda a, x: a + F.pow(x, e))

    def fits(e: Column) -> Column:
        if entropy is not None:
            # H = log(Z) - e * sum(p^e * log p) / Z
            z = lifted(e)
            weighted = F.aggregate(F.col("p"), F.lit(0.0), lambda a, x: a + F.pow(x, e) * F.log(x))
            return F.log(z) - e * weighted / z >= F.lit(entropy) * F.log(F.size("t").cast("double"))
        # Budget over tokens of the source with the smallest share: its number of passes.
        if budget is None:
            return F.pow(F.array_min("p") / F.array_max("p"), e - 1) <= F.lit(repeats)
        return F.lit(float(budget)) * F.pow(F.array_min("p"), e) / lifted(e) / F.array_min("t") <= F.lit(repeats)

    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = (s["low"] + s["high"]) / 2
        up = fits(middle) if entropy is not None else ~fits(middle)
        return F.struct(F.when(up, middle).otherwise(s["low"]).alias("low"), F.when(up, s["high"]).otherwise(middle).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halve)
    one = one.withColumn("e", (found["low"] if entropy is not None else found["high"]))
    one = one.withColumn("z", lifted(F.col("e")))
    # Shown once: the source with the largest share has tokens = budget * weight.
    least = F.col("all") * F.array_max("p") * F.col("z") / F.pow(F.array_max("p"), F.col("e"))
    one = one.withColumn("total", least if budget is None else F.lit(float(budget)))
    rows = one.select("e", "z", "total", "all", F.explode("s").alias("x"))
    weight = F.when(F.col("x.tokens") > 0, F.pow(F.col("x.tokens") / F.col("all"), F.col("e")) / F.col("z")).otherwise(0.0)
    rows = rows.select(F.col("x.source").alias("source"), F.col("x.tokens").alias("tokens"), F.col("e").alias("exponent"), weight.alias("weight"), "total")
    return rows.withColumn("budget", F.floor(F.col("total") * F.col("weight") + 0.5).cast("long")).drop("total")


def mixture(docs: DataFrame, *, seed: str = "1", **targets) -> DataFrame:
    """doc_id, source, n_tokens, copies, weight, exponent and position of each row.

    ``copies`` tells how often the row is in the mixture, ``position`` is the place of its
    block in the source's permutation (from 0).
    """
    rows = stored(counted(docs), "counted")
    blocks = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    blocks = stored(blocks, "blocks")
    chosen = weights(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), **targets)
    chosen = chosen.withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1))
    chosen = chosen.withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("passes") * F.col("tokens")).otherwise(0))
    chosen = stored(chosen.withColumnRenamed("source", "s").drop("tokens"), "weights")
    # At most 4096 rows per source.
    order = W.partitionBy("source").orderBy(_hash(seed, F.coalesce("source", F.lit("")), F.col("block")), "block")
    placed = blocks.withColumn("position", F.row_number().over(order) - 1)
    before = F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, -1))
    placed = placed.withColumn("before", F.coalesce(before, F.lit(0)))
    placed = placed.join(chosen, placed["source"].eqNullSafe(chosen["s"])).drop("s")
    # 1: wholly inside the partial pass, 0: outside, -1: on the border.
    state = F.when(F.col("before") >= F.col("rest"), 0).when(F.col("before") + F.col("tokens") < F.col("rest"), 1).otherwise(-1)
    left = (F.col("rest") - F.col("before")).alias("left")
    placed = placed.select(F.col("source").alias("s"), F.col("block").alias("b"), "position", "passes", "weight", "exponent", state.alias("state"), left)
    joined = rows.join(stored(placed, "placed"), rows["source"].eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    inner = W.partitionBy("source", "block").orderBy(_hash(seed, F.col("doc_hash")), "doc_hash", "n_tokens")
    run = F.coalesce(F.sum("n_tokens").over(inner.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    border = joined.where("state = -1").withColumn("taken", (run < F.col("left")).cast("int"))
    sure = joined.where("state >= 0").withColumn("taken", F.col("state"))
    return sure.unionByName(border).select(
        "doc_id",
        "source",
        "n_tokens",
        (F.col("passes") + F.col("taken")).cast("long").alias("copies"),
        "weight",
        "exponent",
        F.col("position").cast("long").alias("position"),
    )


def mixed_documents(docs: DataFrame, *, seed: str = "1", **targets) -> DataFrame:
    """``docs`` with each row as often as the mixture has it.

    Rows are matched by doc_id, source and number of tokens; of several rows that agree in
    all three, each is taken as often as the first.
    """
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("source", F.lit("")), F.col("source").isNull())
    found = mixture(docs, seed=seed, **targets).select(key.alias("__key"), "copies")
    found = stored(found.groupBy("__key").agg(F.max("copies").alias("__copies")), "copies")
    joined = docs.join(found, key == F.col("__key"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))).alias("__one")).drop("__one")


ORACLE_SQL = f"""
WITH RECURSIVE counted AS (
    SELECT doc_id, source, n_tokens, md5(doc_key) AS doc_hash, substring(md5(doc_key), 1, {DIGITS}) AS block
    FROM (
        SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), '') AS doc_key,
               CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS n_tokens
        FROM documents
    )
),
totals AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY source),
shares AS (SELECT source, tokens, tokens / (SELECT sum(tokens) FROM totals)::DOUBLE AS p FROM totals WHERE tokens > 0),
edges AS (SELECT min(p) AS least, max(p) AS most FROM shares),
halving AS (
    SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
    UNION ALL
    SELECT step + 1,
           CASE WHEN pow(least / most, (low + high) / 2 - 1) <= {REPEATS} THEN low ELSE (low + high) / 2 END,
           CASE WHEN pow(least / most, (low + high) / 2 - 1) <= {REPEATS} THEN (low + high) / 2 ELSE high END
    FROM halving, edges WHERE step < {STEPS}
),
exponent AS (SELECT high AS e FROM halving WHERE step = {STEPS}),
norm AS (SELECT e, sum(pow(p, e)) AS z, max(p) AS most, any_value((SELECT sum(tokens) FROM totals)::DOUBLE) AS everything FROM shares, exponent GROUP BY e),
chosen AS (
    SELECT source, tokens, e AS exponent, pow(p, e) / z AS weight,
           CAST(floor(everything * most * z / pow(most, e) * (pow(p, e) / z) + 0.5) AS BIGINT) AS budget
    FROM shares, norm
    UNION ALL
    SELECT source, tokens, e, 0.0, 0 FROM totals, norm WHERE tokens = 0
),
passes AS (
    SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS passes,
           CASE WHEN tokens > 0 THEN budget - (budget // tokens) * tokens ELSE 0 END AS rest
    FROM chosen
),
blocks AS (SELECT source, block, sum(n_tokens) AS tokens FROM counted GROUP BY source, block),
placed AS (
    SELECT source, block,
           row_number() OVER o - 1 AS position,
           coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM blocks
    WINDOW o AS (PARTITION BY source ORDER BY md5('1:' || coalesce(source, '') || ':' || block), block)
),
ordered AS (
    SELECT c.*, p.position, w.passes, w.weight, w.exponent, w.rest,
           p.before + coalesce(sum(c.n_tokens) OVER (
               PARTITION BY c.source, c.block ORDER BY md5('1:' || c.doc_hash), c.doc_hash, c.n_tokens
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM counted c
    JOIN placed p ON c.block = p.block AND c.source IS NOT DISTINCT FROM p.source
    JOIN passes w ON c.source IS NOT DISTINCT FROM w.source
)
SELECT doc_id, source, n_tokens, CAST(passes + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS copies,
       round(weight, 9) AS weight, round(exponent, 9) AS exponent, position
FROM ordered
"""
