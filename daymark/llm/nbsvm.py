"""Text quality by Naive Bayes support vectors.

Features are indicators of n-grams: of words (one and two), of word shapes (one to three;
a shape has one letter for each run of lower-case letters, capitals or digits), and of how
large a part of a text's word triples occurs in it before. They share a table of 2**18
places by a hash. Each indicator is scaled by the logarithm of the ratio of its smoothed
shares in the two classes, which are counted over all labelled rows of the learning folds.
On these scaled and normalised vectors a linear hinge-loss model is fitted by dual
coordinate descent, on a sample of at most 4,000 distinct texts of each class, each with the
weight of its copies; a fifth of it is set aside to turn margins into probabilities.

Rows: null and empty texts have no features and get the score of the bare intercept. Equal
texts get equal scores. Rows without a label are scored, not learned from; nor are rows
with labels that contradict each other, and rows without doc_id. If labels of one class
only are known, all scores are that class; without labels all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import chunks, distinct_texts, feature_numbers, gram_numbers, mixed, picked_texts, stored, with_computed

PLACES = 1 << 18
#: Distinct texts per class, at most, that the hinge-loss model is fitted on.
SAMPLE_ROWS = 4000
#: Smoothing of the shares, cost of an error, passes over the sample.
ALPHA = 1.0
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.7
#: Bounds of the share of repeated word triples that make up its indicators.
REPEATED = (0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")
_RUNS = np.zeros(256, bool)
_RUNS[[ord("a"), ord("A"), ord("0")]] = True


def _shape(data: bytes) -> bytes:
    kinds = _CLASS[np.frombuffer(data, np.uint8)]
    keep = np.ones(len(kinds), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | ~_RUNS[kinds[1:]]
    return kinds[keep].tobytes()


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The places of each text's indicators, sorted, each once."""
    for _, run in chunks(texts):
        words, w_at = feature_numbers(run)
        shapes, s_at = feature_numbers([_shape(d) for d in run])
        families = [(words, w_at, n, n) for n in (1, 2)] + [(shapes, s_at, n, 8 + n) for n in (1, 2, 3)]
        grams = [(mixed(gram_numbers(x, n) + np.uint64(salt)) % np.uint64(PLACES), at, n) for x, at, n, salt in families]
        triples = gram_numbers(words, 3)
        for i in range(len(run)):
            parts = [g[at[i] : max(at[i], at[i + 1] - n + 1)] for g, at, n in grams]
            own = triples[w_at[i] : max(w_at[i], w_at[i + 1] - 2)]
            if len(own):
                again = 1 - len(np.unique(own)) / len(own)
                level = np.arange(1, 2 + np.searchsorted(REPEATED, again), dtype=np.uint64)
                parts.append(mixed(level + np.uint64(1000)) % np.uint64(PLACES))
            yield np.unique(np.concatenate(parts)).astype(np.int32)


@dataclass
class NbSvm:
    """Weights by place, already scaled, and the calibration of the margin."""

    ratio_squares: np.ndarray
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def margin(self, places: np.ndarray) -> float:
        norm = float(np.sqrt(self.ratio_squares[places].sum(dtype=np.float64)))
        return float(self.weights[places].sum(dtype=np.float64)) / (norm or 1.0) + self.intercept

    def score(self, places: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(places) + self.offset, -40, 40))))


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and intercept of the hinge-loss model; each dual variable is between 0 and
    its row's cost. Rows are unit vectors of the scaled indicators, plus a constant 1."""
    rng = np.random.default_rng(seed)
    norms = np.array([np.sqrt((scale[r] ** 2).sum()) or 1.0 for r in rows])
    values = [scale[r] / n for r, n in zip(rows, norms, strict=True)]
    w, b, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    square = np.array([(v**2).sum() + 1 for v in values])
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + b) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * values[i]
                b += step
    return w, b


def calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through weighted margins, by Newton steps."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    goal = np.where(y > 0, 1 - 1e-3, 1e-3)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (weight * (p - goal)) + 1e-3 * (beta - [1.0, 0.0])
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _counts(rows: DataFrame) -> DataFrame:
    """place, quality and n: labelled rows with the feature; place -1 counts all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, PLACES + 1), np.int64)
        for batch in batches:
            for label, found in zip(batch.column(1).to_pylist(), features(batch.column(0).to_pylist()), strict=True):
                total[label, found] += 1
                total[label, PLACES] += 1
        label, place = np.nonzero(total)
        columns = [pa.array(place.astype(np.int32)), pa.array(label.astype(np.int32)), pa.array(total[label, place])]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "quality", "n"])

    found = rows.select("text", "quality").mapInArrow(run, "place int, quality int, n long")
    return found.groupBy("place", "quality").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> NbSvm | float:
    """Fit on rows (text, quality 0 or 1). With fewer than two classes: a constant score."""
    counts = _counts(labelled).toPandas()
    table = np.zeros((2, PLACES + 1))
    table[counts["quality"], counts["place"]] = counts["n"]
    rows_of = table[:, PLACES]
    if not rows_of.all():
        return 0.5 if not rows_of.any() else float(rows_of[1] > 0)
    shares = (table[:, :PLACES] + ALPHA) / (table[:, :PLACES] + ALPHA).sum(axis=1, keepdims=True)
    ratio = np.log(shares[1] / shares[0])
    texts = picked_texts(labelled.select("text", "quality"), distinct_texts(labelled, "quality"), sample_rows, "quality")
    sample = with_computed(texts, "text", "places array<int>", lambda t: [list(features(t))]).drop("text").dropDuplicates(["h", "quality"]).toPandas()
    sample = sample.sort_values(["h", "quality"], kind="stable")
    rows = [np.asarray(p, np.int64) for p in sample["places"]]
    y = np.where(sample["quality"].to_numpy() > 0, 1.0, -1.0)
    if not len(rows) or abs(y.sum()) == len(y):
        return float(rows_of[1] / rows_of.sum())
    aside = sample["h"].to_numpy() // (1 << 20) % 5 == 0
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside = np.zeros(len(y), bool)
    fit = np.flatnonzero(~aside)
    copies = sample["copies"].to_numpy(np.float64)
    per_class = {c: max(1.0, copies[fit][y[fit] == c].sum()) for c in (1.0, -1.0)}
    cost = np.array([COST * len(fit) * copies[i] / (2 * per_class[y[i]]) for i in fit])
    w, b = dual_coordinate_descent([rows[i] for i in fit], ratio, y[fit], cost)
    model = NbSvm((ratio**2).astype(np.float32), (w * ratio).astype(np.float32), b, 1.0, 0.0)
    held = np.flatnonzero(aside) if aside.any() else fit
    margin = np.array([model.margin(rows[i]) for i in held])
    drawn = {1.0: copies[held][y[held] > 0].sum(), -1.0: copies[held][y[held] < 0].sum()}
    weight = np.array([rows_of[int(y[i] > 0)] / rows_of.sum() * len(held) * copies[i] / drawn[y[i]] for i in held])
    model.slope, model.offset = calibrate(margin, y[held], weight)
    return model


def predict(docs: DataFrame, model: NbSvm | float, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; columns of these names are replaced."""

    def compute(texts: list[str | None]) -> list[list]:
        if isinstance(model, float):
            scores = [model] * len(texts)
        else:
            scores = [model.score(p) for p in features(texts)]
        return [scores, [int(s >= THRESHOLD) for s in scores]]

    return with_computed(docs, text, "score double, predicted int", compute)


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def quality(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row; fold 2 of 4 is held out."""
    known = labels.where(F.col("quality").isin(0, 1) & (_fold() != 2)).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high")
    known = known.select(F.col("doc_id").alias("labelled_id"), F.col("low").cast("int").alias("quality"))
    rows = docs.select("doc_id", "text").where(_fold() != 2)
    # Always by a shuffle, so that small and large tables are handled alike.
    labelled = rows.join(known.hint("merge"), F.col("doc_id") == F.col("labelled_id")).select("text", "quality")
    model = train(stored(labelled, "labelled"), sample_rows=sample_rows)
    all_rows = docs.select("doc_id", "text", F.coalesce(_fold() == 2, F.lit(False)).alias("held_out"))
    return predict(all_rows, model).drop("text")
