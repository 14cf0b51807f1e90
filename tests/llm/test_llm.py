"""The text operators against brute force, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from daymark.llm import (
    byte_cnn,
    decontaminate,
    jaccard_join,
    mixing,
    nbsvm,
    semi_crf,
    suffix_dedup,
    token_files,
    topk_search,
    transcripts,
)
from daymark.llm.common import distinct_texts, picked_texts, shared_folder, stored, table
from daymark.llm.queries import ORACLE_SQL, QUERIES
from verification.compare import connect, difference, session

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


@pytest.fixture(scope="module")
def spark():
    found = session(4)
    table(found, SMALL, "documents")  # tells workers where the package is
    return found


def frame(spark, rows, schema):
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(schema), schema.types)], schema=schema))


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


def awkward(spark, *, extra: bool = True):
    """Documents with nulls, repeated rows, empty and very long texts, and clashing names."""
    rows = [
        (1, "one two three four five six seven", "en", "a", 5),
        (1, "one two three four five six seven", "en", "a", 5),
        (2, "one two three four five six seven", "en", None, 5),
        (3, None, None, "a", None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", "en", "b", 4),
        (None, "nobody 10.0.0.1 knows a@b.co", None, None, 1),
        (6, LONG, "en", "a", len(LONG)),
        (7, LONG + " end", "en", "c", len(LONG)),
        (8, f"before {PASSAGE} after", "en", "a", 1),
        (9, f"{PASSAGE}", "de", "a", 1),
        (10, f"x {PASSAGE} y {PASSAGE} z", "de", "b", 1),
        (11, "été \U0001f600 ça +1 (743) 555-3824; 4111 1111 1111 1111", "fr", "b", 1),
        (12, "a b", "en", "b", 3),
        (13, "a b", "en", "c", 3),
        (14, "ha " * 100, "en", "c", 300),
    ]
    df = frame(spark, rows, DOCS)
    if extra:
        names = ("score", "lang_pred", "block", "set_key", "text_hash", "t1", "hash", "at", "copies", "start", "n_tokens", "quality")
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("other").alias(n) for n in names])
    return df


def nothing(spark):
    return awkward(spark).limit(0)


# 1


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and semi_crf.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = np.random.default_rng(1)
    for _ in range(3000):
        text = "".join(rng.choice(list("aB1234567890@.-+() _%é\n"), rng.integers(0, 60)))
        assert [(s.kind, s.start, s.end) for s in semi_crf.base_spans(text)] == plain_spans(text), text


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "-" * 200_000, "a@" * 100_000):
        semi_crf.base_spans(text)


def test_field_adds_what_patterns_miss_and_keeps_theirs():
    weights = semi_crf.learn(["call +1 (743) 555-3824 now", "at 10.1.2.3 and me@here.example.com", "card 4111 1111 1111 1111 ok"])
    text = "4111 1111 1111 1111 4111 1111 1111 1111 and john (at) mail (dot) com"
    base, found = semi_crf.spans(text, weights)
    assert base == [] and semi_crf.listed(found) == "email:44:68,card:0:19,card:20:39"
    assert semi_crf.spans("nothing here, version 1.2.3 of 2023-01-01", weights) == ([], [])


def test_field_chooses_borders_among_neighbouring_numbers():
    weights = semi_crf.learn(["call +1 (743) 555-3824 now", "at 10.1.2.3 and me@here.example.com", "card 4111 1111 1111 1111 ok"])
    for text, expected in (
        ("Paid 2024 4111 1111 1111 1111 ok", "card:10:29"),
        ("3782 822463 10005 3714 496353 98431", "card:0:17,card:18:35"),
        ("+1 743 555 3824 4111 1111 1111 1111", "card:16:35,phone:0:15"),
        ("00 49 30 1234567 2024 4111 1111 1111 1111 x", "card:22:41,phone:0:16"),
        ("john (at) mail (dot) co (dot) uk now", "email:0:32"),
    ):
        assert semi_crf.listed(semi_crf.spans(text, weights)[1]) == expected, text
    many = " ".join("2024 4111 1111 1111 1111" for _ in range(200))
    assert sum(s.kind == "card" for s in semi_crf.spans(many, weights)[1]) == 200
    digits = " ".join(str(i % 10) for i in range(20))
    assert {(s.start, s.end) for s in semi_crf.candidates(digits, []) if s.kind == "card"} == {
        (2 * i, 2 * (i + n) - 1) for i in range(20) for n in range(13, 20) if i + n <= 20
    }


def test_spelled_out_signs_are_found_in_text_without_digits(spark):
    weights = semi_crf.learn([])
    for text in ("write to john (at) mail (dot) com please", "write to john [at] mail [dot] com please"):
        assert semi_crf.listed(semi_crf.spans(text, weights)[1]) == "email:9:33"
        assert semi_crf.learn([text]) is not None and len(semi_crf.candidates(text, [])) > 0
    rows = frame(spark, [(1, "write to john (at) mail (dot) com please")], pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    assert semi_crf.personal_data(rows).first()["spans"] == "email:9:33"


def test_best_path_and_sums_agree_with_all_segmentations():
    rng = np.random.default_rng(2)
    weights = rng.normal(0, 1, len(semi_crf.NAMES))
    for _ in range(40):
        group = sorted(
            {semi_crf.Segment(a, a + int(rng.integers(1, 4)), str(rng.choice(semi_crf.KINDS))) for a in rng.integers(0, 12, 6).tolist()},
            key=lambda s: (s.end, s.start, s.kind),
        )
        scores = rng.normal(0, 1, len(group))
        number = {s: i for i, s in enumerate(group)}

        def value(path):
            links = sum(weights[semi_crf._link(a, b)] for a, b in itertools.pairwise(path))
            return sum(scores[number[s]] for s in path) + links

        paths = [
            p for n in range(len(group) + 1) for p in itertools.combinations(group, n) if all(a.end <= b.start for a, b in itertools.pairwise(p))
        ]
        assert value(semi_crf.best_path(group, scores, weights)) == pytest.approx(max(map(value, paths)))
        z, into, _ = semi_crf.log_sum(group, scores, weights)
        assert z == pytest.approx(np.logaddexp.reduce([value(p) for p in paths]))
        for i, s in enumerate(group):
            assert into[i] == pytest.approx(sum(np.exp(value(p) - z) for p in paths if s in p))


def test_field_learns_from_the_whole_of_a_text(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(semi_crf, "learn", lambda texts: seen.extend(texts))
    words = " word" * 30
    text = "".join(f"{chr(97 + i % 26)}{words} me{i}@here.example.com{words}\n" for i in range(200))
    rows = frame(spark, [(1, text)], pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    semi_crf.train(rows)
    places = [int(re.search(r"me(\d+)@", p).group(1)) for p in seen]
    assert len(places) == semi_crf.SAMPLE_GROUPS and max(places) > 100 and min(places) < 100
    parts = {f"{chr(97 + i % 26)} me{i}@here.example.com" for i in range(260)}
    found = semi_crf.chosen(parts, 100)
    assert len(found) == 100 and len({p[0] for p in found}) > 15


def test_personal_data_of_awkward_rows(spark):
    rows = semi_crf.personal_data(awkward(spark)).collect()
    assert len(rows) == 16
    empty = hashlib.sha256(b"").hexdigest()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["base_sha256"] == by_id[4]["base_sha256"] == empty and by_id[3]["spans"] == ""
    assert (by_id[None]["n_ip"], by_id[None]["n_email"]) == (1, 1)
    assert (by_id[11]["n_phone"], by_id[11]["n_card"]) == (1, 1)
    assert semi_crf.personal_data(nothing(spark)).count() == 0


# 2


def test_samples_are_bounded_whatever_the_copies(spark):
    rows = [("the same text of many rows 12", q) for q in (0, 1) for _ in range(300)] + [(f"text {i} number {i}", i % 2) for i in range(200)]
    df = frame(spark, rows, pa.schema([("text", pa.string()), ("quality", pa.int32())])).repartition(4)
    for most in (20, 1000):
        found = picked_texts(df, distinct_texts(df, "quality"), most, "quality").dropDuplicates(["h", "quality"]).collect()
        assert Counter(r["quality"] for r in found) == {q: min(most, 101) for q in (0, 1)}
    assert sum(r["copies"] for r in found) == 800 and max(r["copies"] for r in found) == 300
    assert picked_texts(df, distinct_texts(df, "quality"), 1000, "quality").count() <= 4 * 202
    assert picked_texts(df.limit(0), distinct_texts(df.limit(0)), 10).count() == 0


def test_dual_coordinate_descent_separates():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    w, b = nbsvm.dual_coordinate_descent(rows, np.array([1.0, -1.0, 0.1, 0.1]), np.array([1, 1, -1, -1.0]), np.full(4, 10.0))
    scale = np.array([1.0, -1.0, 0.1, 0.1])
    assert [np.sign((w * scale)[r].sum() + b) for r in rows] == [1, 1, -1, -1]


def test_quality_is_learned(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    rows = {r["doc_id"]: r for r in nbsvm.quality(docs, labels).collect()}
    held = [r for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and np.mean([rows[r["doc_id"]]["predicted"] == r["quality"] for r in held]) > 0.93
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in rows)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_quality_of_awkward_rows(spark):
    labels = frame(spark, [(1, 1), (2, 0), (6, 0), (8, 1), (8, 0), (None, 1), (3, None), (9, 1)], pa.schema([("doc_id", pa.int64()), ("quality", pa.int32())]))
    rows = nbsvm.quality(awkward(spark), labels).collect()
    assert len(rows) == 16 and all(r["score"] is not None for r in rows)
    assert {r["score"] for r in nbsvm.quality(awkward(spark), labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in nbsvm.quality(awkward(spark), labels.where("quality = 1 AND doc_id = 9")).collect()} == {1.0}
    assert nbsvm.quality(nothing(spark), labels).count() == 0


# 3


def shingles(words: list[str]) -> Counter:
    return Counter(tuple(words[a : a + 5]) for a in range(len(words) - 4))


def brute_leaks(docs, items) -> dict:
    found = {}
    for doc, text in docs:
        x = (text or "").split()
        for item, y in ((i, t.split()) for i, t in items if t):
            n = min(len(x), len(y))
            for a in range(len(x) - n + 1 if len(y) >= 5 else 0):
                p, q = shingles(x[a : a + n]), shingles(y)
                common = sum((p & q).values())
                similarity = common / (sum(p.values()) + sum(q.values()) - common) if p else 0
                if similarity >= 0.8 and similarity > found.get((doc, item), 0):
                    found[doc, item] = similarity
    return found


def test_leaks_are_those_of_all_windows(spark):
    bench = table(spark, SMALL, "benchmark").collect()
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    rng = np.random.default_rng(3)
    for k in range(60):
        x = bench[k % len(bench)]["text"].split()
        at = int(rng.integers(0, len(x)))
        x = [x, x[:at] + ["zzz"] + x[at + 1 :], x[:at] + x[at + 1 :], x[:at] + ["zzz"] + x[at:]][k % 4]
        docs.append((10_000 + k, " ".join([f"q{j}" for j in range(k % 7)] + x + ["r"] * (k % 3))))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    rows = decontaminate.leaks(frame(spark, docs, schema), table(spark, SMALL, "benchmark")).collect()
    expected = brute_leaks(docs, [(r["item_id"], r["text"]) for r in bench])
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["similarity"]) for r in rows} == expected
    assert len(rows) == len(expected)


def test_every_pair_within_the_radius_shares_a_block():
    rng = np.random.default_rng(4)
    for _ in range(300):
        mask = sum(1 << int(b) for b in rng.choice(64, decontaminate.RADIUS, replace=False))
        flips = set(decontaminate.flips())
        assert any((mask >> (8 * b)) & 255 in flips for b in range(decontaminate.BLOCKS))


def test_decontamination_of_awkward_rows(spark):
    bench = frame(spark, [(1, PASSAGE, "x"), (None, PASSAGE, "x"), (2, None, "x"), (3, "a b", "x"), (4, "", "x")], pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("words", pa.string())]))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(awkward(spark), bench).collect()}
    assert found == {(d, i) for d in (8, 9, 10) for i in (1, None)}
    clean = decontaminate.clean_documents(awkward(spark), bench)
    assert clean.columns == awkward(spark).columns and clean.count() == 13
    assert decontaminate.leaks(nothing(spark), bench).count() == 0
    assert decontaminate.clean_documents(awkward(spark), bench.limit(0)).count() == 16


# 4


def brute_repeats(texts: list[str | None], size: int = 35) -> list[tuple[int, int, str]]:
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    times = Counter(tuple(w[a : a + size]) for w in words for a in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = set()
        for a in range(len(w) - size + 1):
            if times[tuple(w[a : a + size])] > 1:
                gone.update(range(a, a + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("group", [512, 2])
def test_repeated_windows_go(spark, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    docs = awkward(spark).select("doc_id", "text").union(table(spark, SMALL, "documents").selectExpr("doc_id + 100", "text"))
    rows = docs.collect()
    expected = Counter((r["doc_id"], *x) for r, x in zip(rows, brute_repeats([r["text"] for r in rows])))
    assert Counter(tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()) == expected
    assert suffix_dedup.remove_repeats(nothing(spark)).count() == 0


# 5


def test_mixture_meets_its_targets(spark):
    docs = table(spark, LARGER, "documents")
    rows = mixing.mixture(docs, repeats=1.3).toPandas()
    tokens = rows.groupby("source").n_tokens.sum()
    shown = (rows.n_tokens * rows.copies).groupby(rows.source).sum()
    longest = rows.n_tokens.max()
    assert rows.copies.min() == 1 and ((shown / tokens) <= 1.3 + longest / tokens).all()
    assert rows.groupby("source").weight.first().sum() == pytest.approx(1)
    few = mixing.mixture(docs, budget=50_000, entropy=0.97).toPandas()
    assert abs((few.n_tokens * few.copies).sum() - 50_000) < few.source.nunique() * longest
    p = few.groupby("source").weight.first()
    assert -(p * np.log(p)).sum() / np.log(len(p)) >= 0.97 - 1e-9


def test_mixture_of_awkward_rows(spark):
    rows = mixing.mixture(awkward(spark)).collect()
    assert len(rows) == 16 and all(r["copies"] >= 1 for r in rows)
    mixed = mixing.mixed_documents(awkward(spark))
    assert mixed.columns == awkward(spark).columns and mixed.count() >= 16
    assert mixing.mixture(nothing(spark)).count() == 0
    blank = frame(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)
    assert [r["copies"] for r in mixing.mixture(blank).collect()] == [1, 1]


# 6


def test_languages_are_learned(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = {r["doc_id"]: r for r in byte_cnn.identify(docs, sample_rows=150).collect()}
    held = [r for r in docs.collect() if rows[r["doc_id"]]["held_out"]]
    assert np.mean([rows[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)


def test_languages_of_awkward_rows(spark):
    model = byte_cnn.train(awkward(spark), byte_cnn.fold("doc_id", 3) != 5)
    rows = byte_cnn.predict(awkward(spark), model).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == 16 and set(by_id[4].asDict()) == set(awkward(spark).columns)
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (3, 4, 5)] == [("und", 0.0)] * 3
    assert byte_cnn.identify(nothing(spark)).count() == 0
    blank = frame(spark, [(1, "words", None, "a", 0)], DOCS)
    assert byte_cnn.identify(blank).first()["lang_pred"] == "und"


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 80)
    x = np.where(y[:, None] > 0, rng.integers(97, 105, (80, 256)), rng.integers(105, 113, (80, 256))).astype(np.uint8)
    model = byte_cnn.fit(x, y, ["a", "b"], steps=60, seed=1)
    assert (model.probabilities(x).argmax(axis=1) == y).all()


# 7


def test_top_k_of_awkward_vectors(spark):
    nan = float("nan")
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 6) / 8], 0) for i in range(130)]
    rows += [(200, None, 0), (220, [nan] * 6, 0), (221, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (None, [1.0] * 6, 0), (240, [float("inf")] * 6, 0), (222, [], 0)]
    df = frame(spark, rows, pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("score", pa.int32())]))
    whole = np.floor(64 * np.array([r[1] for r in rows[:130]])).astype(int)
    expected = []
    for q in range(0, 130, 20):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(130), -score)) if i != q][:20]
        expected += [(q, k + 1, i, score[i]) for k, i in enumerate(order)]
    assert sorted(tuple(r) for r in topk_search.top_k(df).collect()) == sorted(expected)
    assert topk_search.top_k(df.limit(0)).count() == 0
    assert topk_search.top_k(df.where("vec_id < 5")).count() == 4


def test_top_k_gathers_no_copies_of_queries_on_the_driver(spark, monkeypatch):
    plans = []

    def noted(df, label, keep=topk_search.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(topk_search, "stored", noted)
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in rng.integers(-9, 10, 4) / 16]) for i in range(400)]
    df = frame(spark, rows, pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))]))
    found = topk_search.top_k(df)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 3 and not [p for p in plans if "Broadcast" in p or "CartesianProduct" in p]
    assert found.count() == 400


@pytest.mark.parametrize("size", [1, 4000])
def test_top_k_of_many_blocks_and_groups(spark, monkeypatch, size):
    for name, value in {"CANDIDATES": 300, "QUERIES": 24, "BLOCKS": 3, "GROUP_BYTES": 420}.items():
        monkeypatch.setattr(topk_search, name, value)
    rng = np.random.default_rng(9)
    x = rng.integers(-60, 61, (3000, 7)) / 64 * size
    x[rng.random(3000) < 0.3] = x[20]  # equal scores, at the bound and above it
    x[:40] = -np.abs(x[:40])
    ids = rng.permutation(9000)[:3000] - 2000
    df = frame(spark, list(zip(ids.tolist(), x.tolist())), pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64()))]))
    whole = np.floor(64 * x).astype(np.int64)
    expected = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:20]
        expected += [(ids[q], k + 1, ids[i], score[i]) for k, i in enumerate(order)]
    assert sorted(tuple(r) for r in topk_search.top_k(df).collect()) == sorted(expected)


# 8


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(7)
    log = lambda *s: np.log(rng.dirichlet(np.ones(s[-1]), s[:-1] or None))
    model = transcripts.Model(["a", "b"], log(2), log(2, 2), log(2, 5), log(2, 9), log(2, 6), log(2, 9))
    for _ in range(20):
        seen = np.stack([rng.integers(0, 2, 6), np.zeros(6, int), rng.integers(0, 9, 6), rng.integers(0, 6, 6), rng.integers(0, 9, 6)], axis=1)
        seen[0, 0] = 1

        def value(path):
            e = model.emission(seen)
            total = model.start[path[0]] + e[0, path[0]]
            for i in range(1, 6):
                total += model.step(seen[i, 0], seen[i, 1])[path[i - 1], path[i]] + e[i, path[i]]
            return total

        entry = np.array([-np.inf, -np.inf, 0.0])
        last = int((entry[:, None] + transcripts.run_matrix(model, seen)).max(axis=0).argmax())
        path = transcripts.viterbi(model, seen, entry, last)
        assert value(path) == pytest.approx(max(value(p) for p in itertools.product(range(2), repeat=6)))


def test_long_conversations_are_decoded_as_if_whole(spark, monkeypatch):
    monkeypatch.setattr(transcripts, "RUN", 16)
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    rng = np.random.default_rng(8)
    rows = [(1, i, "user" if i % 2 else "assistant", "x" * int(rng.integers(1, 900)) + ".") for i in range(200)]
    df = frame(spark, rows, schema)
    runs = stored(transcripts.in_runs(df), "runs")
    model = transcripts.train(runs)
    found = [r["roles"] for r in transcripts.decode(runs, model).orderBy("turn").collect()]
    seen = transcripts._lines([r[3] for r in rows])
    entry = np.append(np.full(len(model.roles), -np.inf), 0.0)
    last = int((entry[:, None] + transcripts.run_matrix(model, seen)).max(axis=0).argmax())
    assert found == [model.roles[s] for s in transcripts.viterbi(model, seen, entry, last)]


def test_transcripts_of_awkward_rows(spark):
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("rendered", pa.string())])
    rows = [
        (1, 0, None, "Human: hi?\nAssistant: Hello.\nmore", "x"),
        (1, 0, None, "Human: hi?\nAssistant: Hello.\nmore", "x"),
        (1, None, "system", None, "x"),
        (None, 1, "user", "", "x"),
        (2, 5, "assistant", "y" * 100_000, "x"),
        (3, 0, "user", "one?", "x"),
    ]
    found = transcripts.canonical(frame(spark, rows, schema)).collect()
    assert len(found) == 6
    two = [r for r in found if r["conv_id"] == 1 and r["turn"] == 0]
    assert [r["roles"] for r in two] == ["user,assistant"] * 2 or two[0]["n_turns"] >= 1
    assert transcripts.canonical(frame(spark, rows, schema).limit(0)).count() == 0


def test_roles_are_recovered(spark):
    found = transcripts.canonical(table(spark, LARGER, "conversations")).collect()
    assert np.mean([r["role"] == r["roles"] for r in found]) > 0.95


def test_markers():
    assert [transcripts.observe(x)[0][1] for x in ("User: hi", "### Assistant:", "<|system|>", "[bot] yes", "userland: x", "so: x")] == [
        transcripts.KINDS.index(k) for k in ("user", "assistant", "system", "assistant", "none", "none")
    ]


def test_only_markers_of_the_turn_are_stripped():
    lines = ["User: hi", "Context: a book", "## Context", "Question: which?"]
    assert transcripts.render(["user"] * 4, lines) == "<|user|>\nhi\nContext: a book\n## Context\nQuestion: which?\n<|end|>"
    assert transcripts.render(["user", "assistant"], ["Context: x", "Bot: y"]) == "<|user|>\nContext: x\n<|end|>\n<|assistant|>\ny\n<|end|>"


# 9


def brute_join(docs: list[tuple[int, str]]) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, text in docs:
        w = (text or "").split()
        sets[i] = {tuple(w[a : a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    links, root = Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (find(i), links[i]) for i in sets}


@pytest.mark.parametrize("block", [2048, 7])
def test_join_finds_every_link(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rng = np.random.default_rng(9)
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    base = [f"b{i}" for i in range(120)]
    for k in range(60):  # a group of near copies, and a chain
        x = list(base)
        for at in rng.integers(0, 120, k % 4):
            x[at] = f"c{k}"
        docs.append((5000 + k, " ".join(x[k // 10 : 100 + k // 2])))
    rows = jaccard_join.near_duplicates(frame(spark, docs, pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == brute_join(docs)


def test_pruning_drops_only_improbable_pairs():
    least = jaccard_join.least_matches(0.8, 1e-6)
    assert list(least) == sorted(least) and least[-1] < 0.8 * jaccard_join.HASHES
    rng = np.random.default_rng(10)
    shared = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    left = [np.unique(np.append(shared[: 200 - i], rng.integers(0, 1 << 60, i).astype(np.uint64))) for i in range(40)]
    hashes = np.stack([np.minimum.reduce(((s[:, None] * jaccard_join.FACTORS) >> jaccard_join.HALF), axis=0) for s in left]).astype(np.uint16)
    i, j = jaccard_join.linked_pairs(left, hashes, left, hashes, True)
    expected = {(a, b) for a, b in itertools.combinations(range(40), 2) if len(np.intersect1d(left[a], left[b])) >= 0.8 * len(np.union1d(left[a], left[b]))}
    assert set(zip(i.tolist(), j.tolist())) == expected


def test_rows_of_one_doc_id_stay_or_go_by_themselves(spark):
    words = [" ".join(f"{c}{i}" for i in range(100)) for c in "xyz"]
    docs = [(1, words[0]), (5, words[0] + " end"), (5, words[1]), (6, words[1] + " end"), (5, words[2]), (5, words[2] + " end"), (None, words[2])]
    kept = jaccard_join.one_of_each(frame(spark, docs, pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))).collect()
    assert Counter((r["doc_id"], r["text"][0]) for r in kept) == Counter([(1, "x"), (5, "y"), (5, "z"), (None, "z")])


def test_join_of_awkward_rows(spark):
    rows = jaccard_join.near_duplicates(awkward(spark)).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == 16
    assert (by_id[2]["class_id"], by_id[2]["n_links"], by_id[2]["n_copies"]) == (1, 2, 2)
    assert (by_id[13]["class_id"], by_id[3]["n_links"], by_id[5]["class_id"]) == (12, 0, 5)
    assert by_id[7]["class_id"] == 6
    kept = jaccard_join.one_of_each(awkward(spark))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 11, 12, 14]
    assert jaccard_join.near_duplicates(nothing(spark)).count() == 0


# 10


def test_pieces_give_the_ids_of_whole_texts():
    encoder = token_files.Encoder.of(token_files.tokenizer_path())
    rng = np.random.default_rng(11)
    parts = ["the", "Word", "été", " ", "  ", "\n", "\t", "\r\n", " ", "'s", "12", "!?", "***", "日本", "\U0001f600", "<|endoftext|>", "a.b", "x²"]
    for _ in range(2000):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == expected, repr(text)


def test_names_of_added_tokens_are_those_tokens():
    encoder = token_files.Encoder.of(token_files.tokenizer_path())
    plain = Tokenizer.from_file(token_files.tokenizer_path())
    for text in ("end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b\n<|endoftext|><|endoftext|> c", "end <|endoftext | > next", "plain text"):
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_blocks_come_back_whole_and_from_checkpoints():
    rng = np.random.default_rng(12)
    blocks = [np.minimum(rng.geometric(0.01, n), 4000) for n in (1, 127, 128, 129, 40_000, 70_001)]
    ids, counts = np.unique(np.concatenate(blocks), return_counts=True)
    ids, freq = token_files.frequencies(ids, counts)
    assert freq.sum() == 1 << token_files.SCALE and freq.min() >= 1
    coder = token_files.Coder(ids, freq)
    packed = coder.pack(blocks)
    assert all((a == b).all() for a, b in zip(coder.unpack(packed), blocks, strict=True))
    skip = 2 * token_files.CHECKPOINT_STEPS * token_files.LANES
    assert (coder.unpack(packed[-1:], first_mark=2)[0] == blocks[-1][skip:]).all()
    assert all((a == b).all() for a, b in zip(sum([coder.unpack([p]) for p in packed], []), blocks, strict=True))


def test_token_files_hold_every_document(spark):
    docs = awkward(spark).select("doc_id", "text").union(table(spark, SMALL, "documents").selectExpr("doc_id + 100", "text"))
    encoder = token_files.Encoder.of(token_files.tokenizer_path())
    rows = sorted(docs.collect(), key=lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["text"] or ""))
    expected, start = [], 0
    for r in rows:
        ids = [*encoder.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(tuple(r) for r in token_files.token_files(docs).collect()) == Counter(expected)
    assert token_files.token_files(nothing(spark)).count() == 0


def test_a_damaged_block_is_seen(spark):
    import uuid

    folder = f"{shared_folder(spark)}/damaged-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, SMALL, "documents"), folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    damaged = f"{folder}-2"
    blocks.selectExpr("file_no", "block_no", "n_tokens", "crc32 + 1 AS crc32", "payload", "docs").write.parquet(f"{damaged}/blocks")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{damaged}/table")
    with pytest.raises(Exception, match="checksum"):
        token_files.read_token_files(spark, damaged).collect()


# All


def test_pipeline_of_awkward_rows(spark):
    bench = LARGER
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, bench)
        assert docs.columns == corpus_pipeline.COLUMNS
    assert corpus_pipeline.STAGES[-1][1](spark, docs, bench).count() == docs.count()


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert len(rows) > 100 and min(r["start"] for r in rows) == 0


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_queries_agree_with_their_sql(spark, key):
    assert difference(QUERIES[key](spark, LARGER), connect(LARGER), ORACLE_SQL[key]) is None
