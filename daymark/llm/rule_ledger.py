"""Quality rules as a ledger: every rule is evaluated once, policies read only bits.

``ledger`` measures each text once, and stores the measurements next to one number in which
bit b says that rule b fails. A policy is a version, a mask of rules of which none may fail,
and a mask of rules of which only so many may fail together. Applying a new version, or asking
what each rule does to a policy (``ablations``), reads the ledger and not the texts: verdicts
are bit operations, and ablations start from the number of documents of each pattern of bits,
of which there are at most two to the number of rules.

Everything is built from column functions. Windows of words that repeat within a text are
found inside its row: their hashes are compared first, texts with equal hashes sort them, and
neighbours are compared word by word; no row leaves its task. The sort costs n log n for n
words, and the arrays of one text are in memory together.

Null texts count as empty: no words, so the rule on words fails. Very long texts are measured
whole. Repeated rows, also of one doc_id, are judged one by one; there are no ties. An empty
table gives an empty ledger and no ablations. Columns of the documents are kept, but for those
whose names the ledger takes for itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import WORD, without

WINDOW = 8
_SPACE = r"[\x20\x09-\x0D]"
_NO_SPACE = r"[^\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]"
_LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_bare_words", "n_capitals"]


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` holds; its bit never changes its meaning."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: Integer tests over the measurements, in a form that Spark and DuckDB both read.
RULES = [
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "short_words", "word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 10 * n_words"),
    Rule(6, "bare_words", "5 * n_bare_words > n_words"),
    Rule(7, "capitals", "2 * n_capitals > word_chars"),
]
_BITS = {rule.name: rule.mask for rule in RULES}


def mask(*names: str) -> int:
    return sum(_BITS[name] for name in names)


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails a rule of ``hard``, or more than ``most`` of ``soft``."""

    version: int
    hard: int
    soft: int = 0
    most: int = 0

    def rejects(self, failed: Column, off: Column | int = 0) -> Column:
        """The verdict on failure bits, with the rules of ``off`` switched off."""
        off = F.lit(off) if isinstance(off, int) else off
        left = failed.bitwiseAND(F.bitwise_not(off.cast("long")))
        many = F.bit_count(left.bitwiseAND(F.lit(self.soft))) > self.most
        return (left.bitwiseAND(F.lit(self.hard)) != 0) | many


BASE = mask("few_words", "repeated_windows")
#: The versions so far; a version is never changed, a new one is added.
POLICIES = {
    1: Policy(1, BASE),
    2: Policy(2, BASE | mask("symbols", "repeated_lines", "bare_words", "capitals"), mask("short_words", "long_words")),
}
CURRENT = 2


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements of every whole text."""
    names = [*MEASURES, "failed"]
    rows = without(docs.withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), names)
    words = F.array_remove(F.split("__text", f"{_SPACE}+", -1), "")
    lines = F.filter(F.split("__text", "\n", -1), lambda line: F.rlike(line, F.lit(_NO_SPACE)))
    # Each step reads the columns of the one before it more than once, so none is computed twice.
    rows = rows.withColumns({"__words": words, "__lines": lines})
    window = F.transform(
        F.when(F.size("__words") >= WINDOW, F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1))).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.slice("__words", i, F.lit(WINDOW))),
    )
    rows = rows.withColumn("__hashes", window)
    paired = F.array_sort(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn("__sorted", F.when(repeats, paired).otherwise(empty))
    rows = rows.withColumn("__places", F.array_sort(F.transform(F.filter("__sorted", _found_again), lambda x: x["i"])))
    covered = F.transform("__places", lambda p, k: F.coalesce(F.least(F.get("__places", k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    bare = F.filter("__words", lambda w: ~F.rlike(w, F.lit(_LETTER)))
    # In the order of MEASURES.
    values = [
        F.size("__words"),
        F.char_length(F.array_join("__words", "")),
        F.regexp_count("__text", F.lit(_SYMBOL)),
        F.size("__lines"),
        F.size("__lines") - F.size(F.array_distinct("__lines")),
        F.aggregate(covered, F.lit(0), lambda total, n: total + n),
        F.size(bare),
        F.regexp_count("__text", F.lit("[A-Z]")),
    ]
    rows = rows.withColumns({name: value.cast("long") for name, value in zip(MEASURES, values, strict=True)})
    return rows.drop("__text", "__words", "__lines", "__hashes", "__sorted", "__places")


def _found_again(x: Column, k: Column) -> Column:
    """Whether the window of ``x`` equals one of its neighbours in the order of hashes."""

    def same(y: Column) -> Column:
        equal = F.slice("__words", x["i"], F.lit(WINDOW)) == F.slice("__words", y["i"], F.lit(WINDOW))
        return F.coalesce((x["h"] == y["h"]) & equal, F.lit(False))

    return same(F.get("__sorted", k - 1)) | same(F.get("__sorted", k + 1))


def ledger(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with measurements and ``failed``, the bits of the rules that fail."""
    failed = F.lit(0).cast("long")
    for rule in rules:
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(rule.mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured(docs, text).withColumn("failed", failed)


def judged(rows: DataFrame, policy: Policy, verdict: str = "kept") -> DataFrame:
    """A ledger with the verdict of one policy."""
    return rows.withColumn(verdict, ~policy.rejects(F.col("failed")))


def ablations(rows: DataFrame, policies: list[Policy], rules: list[Rule] = RULES) -> DataFrame:
    """What each rule does to each policy: version, rule, n_docs, n_failed (documents that fail
    the rule), n_rejected, n_rejected_without (with the rule switched off) and n_alone
    (rejected for this rule only); ``seen`` are the bits that fail anywhere."""
    patterns = rows.groupBy("failed").agg(F.count("*").alias("n"))
    found = F.col("failed")
    entries = []
    for policy in policies:
        for rule in rules:
            with_rule, without_rule = policy.rejects(found), policy.rejects(found, rule.mask)
            entries.append(
                F.struct(
                    F.lit(policy.version).alias("version"),
                    F.lit(rule.name).alias("rule"),
                    (found.bitwiseAND(F.lit(rule.mask)) != 0).alias("fails"),
                    with_rule.alias("rejected"),
                    without_rule.alias("rejected_without"),
                )
            )
    each = patterns.select("failed", "n", F.explode(F.array(*entries)).alias("e")).select("failed", "n", "e.*")

    def documents(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(0))

    return each.groupBy("version", "rule").agg(
        F.sum("n").alias("n_docs"),
        documents(F.col("fails")).alias("n_failed"),
        documents(F.col("rejected")).alias("n_rejected"),
        documents(F.col("rejected_without")).alias("n_rejected_without"),
        documents(F.col("rejected") & ~F.col("rejected_without")).alias("n_alone"),
        F.bit_or("failed").alias("seen"),
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, measurements, failure bits, base_failed, and kept by the current policy."""
    rows = judged(ledger(docs), POLICIES[CURRENT])
    base = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return rows.select("doc_id", *MEASURES, "failed", base.alias("base_failed"), (~base & F.col("kept")).alias("kept"))


_FAILED = " + ".join(f"CASE WHEN {rule.fails} THEN {rule.mask} ELSE 0 END" for rule in RULES)
ORACLE_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_NO_SPACE}')) AS ls
    FROM documents
),
windows AS (
    SELECT r, i, array_to_string(ws[i : i + {WINDOW - 1}], ' ') AS s FROM d, unnest(range(1, len(ws) - {WINDOW - 2})) AS t(i) WHERE len(ws) >= {WINDOW}
),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM again, unnest(range(i, i + {WINDOW})) AS t(j) GROUP BY r),
m AS (
    SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
           len(regexp_extract_all(text, '{_SYMBOL}')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(list_filter(ws, lambda w: NOT regexp_matches(w, '{_LETTER}'))) AS n_bare_words,
           len(regexp_extract_all(text, '[A-Z]')) AS n_capitals
    FROM d LEFT JOIN covered USING (r)
),
f AS (SELECT *, CAST({_FAILED} AS BIGINT) AS failed FROM m)
SELECT doc_id, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in MEASURES)}, failed, failed & {BASE} <> 0 AS base_failed,
       failed & {POLICIES[CURRENT].hard} = 0 AND bit_count(failed & {POLICIES[CURRENT].soft}) <= {POLICIES[CURRENT].most} AS kept
FROM f
"""
