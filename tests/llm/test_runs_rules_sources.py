"""Periodic runs, the rule ledger and the source audit against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from daymark.llm import divergence, periodic_runs, rule_ledger
from daymark.llm.common import table
from daymark.llm.queries import ORACLE_SQL, QUERIES
from verification.compare import connect, difference, session

SMALL = "/root/testdata/sf0.001"
DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def spark():
    found = session(4)
    table(found, SMALL, "documents")  # tells workers where the package is
    return found


def documents(spark, rows):
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(DOCS)
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, DOCS.types, strict=True)], schema=DOCS))


def awkward():
    draw = random.Random(7)
    rows = [(None, "a b " * 20, "en", "a", 1), (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "de", "b", 3)]
    rows += [(4, "x x x x x x", "en", "a", 1)] * 2
    rows += [(5, "tick tock " * 9 + "end", "", "b", 1), (6, " " * 7 + " " + "\x1f \x00" * 5, "de", "c", 1)]
    rows += [(7, " ".join(f"w{i % 1013}" for i in range(30_000)), "en", "c", 1)]
    rows += [(8, "One LINE\nOne LINE\n\n \nEND!!\nOne LINE ", "fr", "c", 1), (9, "### $$$ | & <b>" * 8, "fr", "a", 1)]
    rows += [(10, "Ä ö ÀB zZ naïve " * 30, "fr", "b", 1), (11, "1 2 3 4 5 6 7 8 9 " * 3, "de", "b", 1)]
    for i in range(20, 80):
        words = [draw.choice(["alpha", "Beta", "gamma,", "δ", "e", "FF"]) for _ in range(draw.randrange(90))]
        if draw.random() < 0.5 and words:
            words += words[: draw.randrange(1, 9)] * draw.randrange(2, 12)
        rows.append((i, draw.choice([" ", "\n", " \r\n"]).join(words), draw.choice(["en", "de"]), draw.choice("abcd"), len(words)))
    return rows


def runs_by_pairs(words):
    """Every period, every stretch of words that equal the word one period on."""
    found = set()
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            smaller = any(all(words[k] == words[k + r] for k in range(at, at + length - r)) for r in range(1, q))
            if end > at and length >= max(6, 4 * q) and not smaller:
                found.add((at, length, q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def report_by_pairs(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_pairs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    digest = [hashlib.sha256(s.encode()).hexdigest() for s in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digest)


def test_runs_of_awkward_texts(spark):
    rows = [r for r in awkward() if r[0] != 7]
    found = periodic_runs.run_report(periodic_runs.planted(documents(spark, rows)))
    assert Counter(map(tuple, found.collect())) == Counter(report_by_pairs(r[0], r[1]) for r in rows)
    assert periodic_runs.run_report(periodic_runs.planted(documents(spark, []))).collect() == []


def test_long_run(spark):
    # Words 1,013 apart are equal, and so are the five words that begin anywhere.
    row = periodic_runs.run_report(documents(spark, [r for r in awkward() if r[0] == 7])).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 30_000, 1013, 29_615)


def test_runs_of_random_words():
    draw = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(draw.randrange(1, 5)):
            some = draw.choice([1, 2, 3, 40])
            words = [b"%d" % draw.randrange(some) for _ in range(draw.randrange(70))]
            if words and draw.random() < 0.6:
                a = draw.randrange(len(words))
                p = 1 + (len(words) - a) // draw.randrange(3, 11)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        expected = [runs_by_pairs(words) for words in texts]
        assert periodic_runs.runs_of_texts(texts) == expected
        # The choice of pieces leaves nothing out: whole texts give the same.
        assert periodic_runs.runs_of_pieces(texts) == expected


def test_suffix_tree_orders_and_extensions():
    draw = random.Random(5)
    import numpy as np

    for _ in range(60):
        s = [draw.randrange(1, draw.choice([2, 4, 9])) for _ in range(draw.randrange(1, 200))] + [0]
        order = np.arange(10)
        tree = periodic_runs.SuffixTree(s, [order])
        assert tree.ranks[0].tolist() == [sorted(range(len(s)), key=lambda i: s[i:]).index(i) for i in range(len(s))]
        i, j = np.array([(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]).reshape(-1, 2).T
        expected = [next(k for k in range(len(s)) if s[a + k] != s[b + k]) for a, b in zip(i, j, strict=True)]
        assert tree.common(i, j).tolist() == expected


def test_runs_keep_clashing_columns(spark):
    docs = documents(spark, [(1, "a b a b a b a b c", "en", "s", 1)]).selectExpr("doc_id", "text", "lang AS RUNS", "source AS Collapsed", "n_chars")
    row = periodic_runs.with_runs(docs).first()
    assert set(row.asDict()) == {"doc_id", "text", "n_chars", "runs", "n_words", "collapsed"}
    assert (row.collapsed, row.n_words, [tuple(r) for r in row.runs]) == ("a b c", 9, [(0, 8, 2)])


def test_planted_query(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    found = QUERIES["op11_periodic_runs"](spark, SMALL).collect()
    assert len(found) == len(docs)
    short = {d.doc_id: d.text for d in docs if d.text is None or len(d.text) < 3000}
    assert len(short) > 100
    expected = Counter(report_by_pairs(k, t) for k, t in short.items())
    assert Counter(tuple(r) for r in found if r.doc_id in short) == expected


def measures_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(8)}
    bare = [w for w in words if not re.search(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]", w)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_bare_words": len(bare),
        "n_capitals": len(re.findall("[A-Z]", text)),
    }


def test_ledger_measures(spark):
    rows = awkward()
    found = rule_ledger.quality_rules(documents(spark, rows)).collect()
    names = ["doc_id", *rule_ledger.MEASURES]
    expected = []
    for row in rows:
        m = measures_by_hand(row[1])
        base = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
        failed = sum(rule.mask for rule in rule_ledger.RULES if eval(rule.fails, {}, m))
        expected.append((row[0], *m.values(), failed, base))
        assert base == bool(failed & rule_ledger.BASE)
    assert Counter(tuple(r[c] for c in [*names, "failed", "base_failed"]) for r in found) == Counter(expected)
    policy = rule_ledger.POLICIES[rule_ledger.CURRENT]
    for r in found:
        rejected = r.failed & policy.hard or bin(r.failed & policy.soft).count("1") > policy.most
        assert r.kept == (not r.base_failed and not rejected)
    assert rule_ledger.quality_rules(documents(spark, [])).collect() == []


def test_policies_and_ablations(spark):
    rows = rule_ledger.ledger(documents(spark, awkward()))
    policies = [*rule_ledger.POLICIES.values(), rule_ledger.Policy(3, 0, rule_ledger.BASE | rule_ledger.mask("symbols"), 1)]
    bits = [r.failed for r in rows.collect()]

    def rejects(policy, failed):
        return bool(failed & policy.hard) or bin(failed & policy.soft).count("1") > policy.most

    for policy in policies:
        assert [r.kept for r in rule_ledger.judged(rows, policy).collect()] == [not rejects(policy, b) for b in bits]
    expected = set()
    for policy in policies:
        for rule in rule_ledger.RULES:
            without = [rejects(policy, b & ~rule.mask) for b in bits]
            all_rules = [rejects(policy, b) for b in bits]
            alone = sum(x and not y for x, y in zip(all_rules, without, strict=True))
            seen = 0
            for b in bits:
                seen |= b
            expected.add((policy.version, rule.name, len(bits), sum(bool(b & rule.mask) for b in bits), sum(all_rules), sum(without), alone, seen))
    found = rule_ledger.ablations(rows, policies)
    assert {tuple(r) for r in found.collect()} == expected
    assert rule_ledger.ablations(rows.limit(0), policies).collect() == []


def test_ledger_is_native_and_keeps_columns(spark):
    docs = documents(spark, awkward()).withColumnsRenamed({"lang": "N_WORDS", "source": "Failed"})
    rows = rule_ledger.ledger(docs)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas", "Exchange"))
    assert rows.columns == ["doc_id", "text", "n_chars", *rule_ledger.MEASURES, "failed"]


def divergence_by_hand(rows, least=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for _, text, lang, source, _ in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang, source, [t.translate(lower) for t in ts]) for lang, source, ts in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        often = Counter(t for _, _, ts in own for t in set(ts))
        kept = {t for t, n in often.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, ts in own:
            counts[source].update(t for t in ts if t in kept)
        whole = sum(counts.values(), Counter())

        def shares(c, kept=kept):
            size = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // size for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for a in p:
            pairs = sorted(((-sum((p[a][t] - p[b][t]) ** 2 // (p[a][t] + p[b][t]) for t in kept), b.encode()) for b in p if b != a))
            out |= {(lang, a, "pair", b.decode(), -v, k + 1) for k, (v, b) in enumerate(pairs)}
            terms = sorted((-((p[a][t] - q[t]) ** 2 // (p[a][t] + q[t])), t.encode()) for t in kept if counts[a][t] and p[a][t] > q[t])
            out |= {(lang, a, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(terms[:top])}
    return out


@pytest.mark.parametrize("nodes", [1 << 18, 3])
def test_divergence_by_hand(spark, monkeypatch, nodes):
    monkeypatch.setattr(divergence, "MOST_NODES", nodes)
    rows = awkward()
    rows += [(200 + i, f"common word{i % 3} Übung ÜBUNG", "zz", source, 1) for i in range(30) for source in ("p", "q", "r")[: 1 + i % 3]]
    rows += [(300, None, "empty", "p", 1), (301, "few terms", "empty", "q", 1)]
    found = divergence.divergence(documents(spark, rows)).collect()
    assert {tuple(r) for r in found} == divergence_by_hand(rows) and len(found) == len(set(found))
    assert divergence.divergence(documents(spark, [])).collect() == []


def test_tree_shares_nodes():
    tree = divergence._Tree()
    paths = [([(0, 9, 2), (1, 7, 3), (2, 5, 1)], 4), ([(0, 9, 2), (1, 7, 3)], 2), ([(0, 9, 2), (2, 5, 1)], 1)]
    assert [tree.insert(*p) for p in paths] == [3, 0, 1]
    assert tree.count == [7, 6, 4, 1]
    sums = Counter()
    for upper, lower, values in tree.corrections():
        for a, b, v in zip(upper.tolist(), lower.tolist(), values.tolist(), strict=True):
            sums[a, b] += v

    def f(x, y):
        return (x - y) ** 2 // (x + y)

    expected = Counter()
    for path, times in paths:
        for i, (a, p, p0) in enumerate(path):
            for b, q, q0 in path[i + 1 :]:
                expected[a, b] += times * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    assert sums == expected


@pytest.mark.parametrize("key", ["op12_quality_rules", "op13_source_divergence"])
def test_sql(spark, key):
    assert difference(QUERIES[key](spark, SMALL), connect(SMALL), ORACLE_SQL[key]) is None


def thue_morse(n):
    """Two different strings that every polynomial hash modulo 2**64 takes for one."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_long_words_are_told_apart(spark):
    import corpus_pipeline
    from daymark.llm import jaccard_join, suffix_dedup

    before, after = (" ".join(f"{c}{i}" for i in range(20)) for c in "xy")
    docs = documents(spark, [(i, f"{before} {w} {after}", "en", "a", 1) for i, w in enumerate(thue_morse(2048))])
    assert [r.n_removed for r in suffix_dedup.remove_repeats(docs).collect()] == [0, 0]
    found = {r.doc_id: (r.class_id, r.n_copies) for r in jaccard_join.near_duplicates(docs).collect()}
    # 32 of 42 shingles are in both texts: no link.
    assert found == {0: (0, 0), 1: (1, 0)}
    assert corpus_pipeline.jaccard(spark, docs, SMALL).count() == 2


def test_numerals_are_no_letters():
    from daymark.llm.byte_cnn import has_letter

    assert not any(map(has_letter, ["²½", "ⅧⅢ", "①", "12_3", "", None])) and all(map(has_letter, ["²a", "é", "字"]))


def test_slices_bound_bytes_and_lose_no_row():
    from daymark.llm.common import slices

    texts = ["x" * n for n in (0, 5, 100, 3, 3, 3, 50, 0)] + [None, "yy"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], names=["i", "t"])
    parts = list(slices(batch, 1, 10))
    assert [v for p in parts for v in p.column(1).to_pylist()] == texts and len(parts) > 3
    assert all(sum(len(v or "") for v in p.column(1).to_pylist()[1:]) <= 10 for p in parts)
    assert list(slices(batch.slice(0, 0), 1)) == []
