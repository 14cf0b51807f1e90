"""Language identification with a small convolutional network over bytes.

A text is cut into windows of 256 bytes, the whole of it. Filters of several widths slide
over each window, the largest response of each filter is kept, and a softmax layer turns
these into languages; a document gets the mean of its windows. The network is trained in
numpy on windows of a bounded, stratified sample of labelled rows and sent to the tasks.

Rows: a null text and a text without any letter are ``und`` with score 0. Without labelled
rows nothing is learned, and all rows are ``und``. Equal texts get equal results, so
repeated rows do too. Null labels and null keys are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import distinct_texts, picked_texts, with_computed

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBEDDING = 8
UNKNOWN = "und"
#: Labelled rows per language, in expectation, and windows of each.
SAMPLE_ROWS = 600
SAMPLE_WINDOWS = 4
#: More distinct labels than this are refused: they are no languages.
MOST_LANGUAGES = 2000
#: Windows that are computed together.
TOGETHER = 64


@dataclass
class ByteCnn:
    """Weights; ``filters`` has one column per filter, zero beyond the filter's width."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """For each position the embedded bytes that a filter of the largest width sees."""
        n, widest = len(windows), max(WIDTHS)
        padded = np.zeros((n, WINDOW + widest - 1), np.uint8)
        padded[:, :WINDOW] = windows
        embedded = self.embedding[padded]
        step = embedded.strides
        return np.lib.stride_tricks.as_strided(
            embedded,
            (n, WINDOW, widest * EMBEDDING),
            (step[0], step[1], step[2]),
        ).reshape(n * WINDOW, widest * EMBEDDING)

    def forward(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities, pooled responses and the position of each largest response."""
        response = (self.columns(windows) @ self.filters).reshape(len(windows), WINDOW, -1)
        where = response.argmax(axis=1)
        top = np.take_along_axis(response, where[:, None, :], axis=1)[:, 0, :]
        pooled = np.maximum(top + self.bias, 0)
        return _softmax(pooled @ self.dense + self.dense_bias), pooled, where

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = []
        for i in range(0, len(windows), TOGETHER):
            part = windows[i : i + TOGETHER]
            response = (self.columns(part) @ self.filters).reshape(len(part), WINDOW, -1)
            pooled = np.maximum(response.max(axis=1) + self.bias, 0)
            parts.append(_softmax(pooled @ self.dense + self.dense_bias))
        return np.concatenate(parts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: str) -> np.ndarray:
    """The whole text, in lower case, as rows of bytes; the last row is padded."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    rows = -(-len(data) // WINDOW)
    padded = np.zeros(rows * WINDOW, np.uint8)
    padded[: len(data)] = data
    return padded.reshape(rows, WINDOW)


def has_letter(text: str | None) -> bool:
    """Whether a character is a letter; numerals such as "²", "½" or "Ⅷ" are none."""
    return text is not None and any(map(str.isalpha, text))


def _sampled_windows(texts: list[str | None]) -> list[list[bytes]]:
    out = []
    for text in texts:
        rows = windows_of(text) if has_letter(text) else np.zeros((0, WINDOW), np.uint8)
        pick = np.unique(np.linspace(0, len(rows) - 1, SAMPLE_WINDOWS).astype(int)) if len(rows) else []
        out.append([rows[i].tobytes() for i in pick])
    return [out]


def train(
    docs: DataFrame,
    usable: Column,
    *,
    text: str = "text",
    label: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    steps: int = 900,
    seed: int = 7,
) -> ByteCnn | None:
    """Fit on rows where ``usable`` holds and the label is set.

    At most ``sample_rows`` distinct texts of each language are taken by a hash, each with the
    weight of its copies, and ``SAMPLE_WINDOWS`` windows spread over each of them; that is all
    the driver sees.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang")).where(
        usable & F.col(label).isNotNull() & F.col(text).isNotNull()
    )
    texts = distinct_texts(rows, "lang")
    counts = [r["lang"] for r in texts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct labels")
    if not counts:
        return None
    sample = with_computed(picked_texts(rows, texts, sample_rows, "lang"), "text", "windows array<binary>", _sampled_windows)
    data = sample.select("h", "lang", "copies", "windows").dropDuplicates(["h", "lang"]).toPandas()
    data = data.sort_values("windows", key=lambda s: s.map(tuple), kind="stable")
    languages = sorted(counts)
    number = {x: i for i, x in enumerate(languages)}
    pairs = [(w, number[lang], n) for lang, ws, n in zip(data["lang"], data["windows"], data["copies"], strict=True) for w in ws]
    if not pairs:
        return None
    x = np.frombuffer(b"".join(w for w, _, _ in pairs), np.uint8).reshape(-1, WINDOW)
    y = np.array([c for _, c, _ in pairs])
    weight = np.array([n for _, _, n in pairs], np.float64)
    return fit(x, y, languages, steps=steps, seed=seed, weight=weight)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], *, steps: int, seed: int, batch: int = 64, weight: np.ndarray | None = None) -> ByteCnn:
    """Adam on the cross entropy of windows, each language drawn equally often, and each of
    its windows by its weight."""
    rng = np.random.default_rng(seed)
    n_filters, widest = FILTERS * len(WIDTHS), max(WIDTHS)
    mask = np.zeros((widest * EMBEDDING, n_filters), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
    draw = lambda *shape, s=0.3: rng.normal(0, s, shape).astype(np.float32)
    model = ByteCnn(
        languages,
        draw(256, EMBEDDING),
        draw(widest * EMBEDDING, n_filters) * mask,
        np.zeros(n_filters, np.float32),
        draw(n_filters, len(languages)),
        np.zeros(len(languages), np.float32),
    )
    names = ("embedding", "filters", "bias", "dense", "dense_bias")
    first = {k: np.zeros_like(getattr(model, k)) for k in names}
    second = {k: np.zeros_like(getattr(model, k)) for k in names}
    of_class = [np.flatnonzero(y == c) for c in range(len(languages))]
    weight = np.ones(len(y)) if weight is None else weight
    reach = [np.cumsum(weight[w]) for w in of_class]
    present = [c for c in range(len(languages)) if len(of_class[c])]
    for step in range(1, steps + 1):
        classes = rng.choice(present, batch)
        pick = np.array([of_class[c][np.searchsorted(reach[c], rng.random() * reach[c][-1], side="right")] for c in classes])
        part = x[pick]
        # Some windows are cut short, so that short texts are learned too.
        cut = np.where(rng.random(batch) < 0.3, rng.integers(16, WINDOW, batch), WINDOW)
        part = np.where(np.arange(WINDOW)[None, :] < cut[:, None], part, 0).astype(np.uint8)
        p, pooled, where = model.forward(part)
        delta = p.copy()
        delta[np.arange(batch), classes] -= 1
        delta /= batch
        grad = {"dense": pooled.T @ delta, "dense_bias": delta.sum(axis=0)}
        back = (delta @ model.dense.T) * (pooled > 0)
        grad["bias"] = back.sum(axis=0)
        seen = model.columns(part).reshape(batch, WINDOW, -1)
        at = np.take_along_axis(seen[:, :, :], where[:, :, None], axis=1)
        grad["filters"] = np.einsum("bfe,bf->ef", at, back) * mask
        into = back[:, :, None] * model.filters.T[None, :, :]
        padded = np.zeros((batch, WINDOW + widest - 1), np.uint8)
        padded[:, :WINDOW] = part
        spots = where[:, :, None] + np.arange(widest)[None, None, :]
        bytes_at = np.take_along_axis(padded[:, None, :], spots.reshape(batch, 1, -1), axis=2).reshape(-1)
        grad["embedding"] = np.zeros_like(model.embedding)
        np.add.at(grad["embedding"], bytes_at, into.reshape(-1, EMBEDDING))
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * grad[k]
            second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
            move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            setattr(model, k, (getattr(model, k) - rate * move).astype(np.float32))
    return model


def predict(docs: DataFrame, model: ByteCnn | None, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""

    def compute(texts: list[str | None]) -> list[list]:
        names, scores = [], []
        for t in texts:
            if model is None or not has_letter(t):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            p = model.probabilities(windows_of(t)).mean(axis=0, dtype=np.float64)
            best = int(p.argmax())
            names.append(model.languages[best])
            scores.append(float(min(1.0, p[best])))
        return [names, scores]

    return with_computed(docs, text, "lang_pred string, score double", compute)


def fold(key: str, parts: int) -> Column:
    """The fold of a row: crc32 of its key as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def identify(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs``.

    Rows of fold 1 of 3 are held out: they are predicted, but not learned from. A null
    doc_id has no fold; it is not learned from and not held out.
    """
    model = train(docs, fold("doc_id", 3) != 1, sample_rows=sample_rows)
    rows = docs.select("doc_id", "text", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"))
    return predict(rows, model).drop("text")
