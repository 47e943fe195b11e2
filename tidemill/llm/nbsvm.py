"""Quality classifier: naive Bayes support vectors.

A text's features are its distinct byte n-grams, hashed to ``2 ** DIM_BITS``
places, and n-grams of a second reading of the text in which a word only counts
as "same as the one before" or not: how long such runs get, and how much of the
text they make up. Each feature is scaled by the logarithm of its class count ratio (naive Bayes); the scaled
vector has length one. A linear hinge-loss model is fitted to these vectors by
dual coordinate descent. Its margin becomes a probability by a logistic curve,
fitted on every fifth row of the sample, which the descent does not see.

The model is fitted on at most ``max_rows`` labelled rows, those with the least
hash of their id; this bound alone allows fitting in one task and sending the
sample of labels to every task. Scores read whole texts.

Empty and null texts have no features and score as the bias says. Without rows
of both classes every score is the smoothed share of label 1. Labels that are
null are not used; ids, languages and sources are never features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import rolling as R
from tidemill.llm.common import besides, prepared, unused
from tidemill.llm.common import col as named

DIM_BITS = 17
GRAMS = (2, 3, 4)
MAX_ROWS = 8000


#: Runs of a repeated word, and shares (in percent) of words that repeat the one before, that are features.
RUN_LENGTHS = np.array([1, 2, 3, 4, 6, 8, 12])
REPEAT_SHARES = np.array([2, 5, 10, 20, 30, 45])


def repeat_features(texts: list[bytes]) -> np.ndarray:
    """Keys of the features on repeated words."""
    w = R.words_of(texts)
    n = np.diff(w.bounds)
    of = np.repeat(np.arange(len(texts)), n)
    same = np.zeros(len(of) + 1, bool)
    same[1:-1] = (w.hashes[1:] == w.hashes[:-1]) & (of[1:] == of[:-1])
    step = np.diff(same.astype(np.int8))
    first, last = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, of[first], last - first)
    share = 100 * np.bincount(of[same[:-1]], minlength=len(texts)) / np.maximum(n, 1)
    found = np.concatenate((longest[:, None] >= RUN_LENGTHS, share[:, None] >= REPEAT_SHARES), axis=1)
    text, feature = np.nonzero(found)
    places = R.mixed(np.arange(1, found.shape[1] + 1, dtype=R.U64)) >> R.U64(64 - DIM_BITS)
    return (text.astype(R.U64) << R.U64(DIM_BITS)) | places[feature]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct feature numbers of all texts, one after another, and where each text's begin."""
    slab = R.bytes_of(texts)
    prefix = R.Prefix(R.byte_values(slab.data))
    of = np.repeat(np.arange(len(texts), dtype=R.U64), np.diff(slab.bounds))
    ends = np.repeat(slab.bounds[1:], np.diff(slab.bounds))
    keys = [repeat_features(texts)]
    for size in GRAMS:
        h = prefix.windows(size) >> R.U64(64 - DIM_BITS)
        whole = np.arange(len(h)) + size <= ends[: len(h)]
        keys.append((of[: len(h)][whole] << R.U64(DIM_BITS)) | h[whole])
    key = np.concatenate(keys)
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    bounds = np.searchsorted(key, np.arange(len(texts) + 1, dtype=R.U64) << R.U64(DIM_BITS))
    return (key & R.U64((1 << DIM_BITS) - 1)).astype(np.int32), bounds


@dataclass
class Model:
    weights: np.ndarray  # one per feature, the ratio not yet applied
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: list[bytes]) -> np.ndarray:
        at, bounds = features(texts)
        r = self.ratios[at]
        sums = np.concatenate(([0.0], np.cumsum(r * self.weights[at])))
        squares = np.concatenate(([0.0], np.cumsum(r * r)))
        length = np.sqrt(np.maximum(squares[bounds[1:]] - squares[bounds[:-1]], 0))
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.where(length > 0, length, 1.0) + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -30, 30)))


def constant(share: float) -> Model:
    none = np.zeros(1 << DIM_BITS)
    return Model(none, none, 0.0, 0.0, float(np.log(share / (1 - share))))


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = 1.0, rounds: int = 15, seed: int = 1) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; vectors have length one, and the bias is one more feature."""
    w, bias, alpha = np.zeros(1 << DIM_BITS), 0.0, np.zeros(len(y))
    square = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            at, v = rows[i], values[i]
            gradient = y[i] * (w[at] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps on smoothed targets."""
    pos, neg = label.sum(), (~label).sum()
    target = np.where(label, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        v = p * (1 - p)
        h = np.array([[(v * margin * margin).sum(), (v * margin).sum()], [(v * margin).sum(), v.sum()]]) + np.eye(2) * 1e-6
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit(texts: list[bytes], labels: np.ndarray, smooth: float = 1.0) -> Model:
    """``labels`` is boolean, one per text."""
    if not labels.any() or labels.all():
        return constant((labels.sum() + 1) / (len(labels) + 2))
    rows = []
    for slab in R.slabs([(0, t) for t in texts]):
        at, bounds = features([t for _, t in slab])
        rows += [at[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    counts = np.full((2, 1 << DIM_BITS), smooth)
    held = np.arange(len(labels)) % 5 == 4
    learn = ~held if labels[~held].any() and not labels[~held].all() else np.ones(len(labels), bool)
    for i in np.flatnonzero(learn):
        counts[int(labels[i]), rows[i]] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = []
    for at in rows:
        v = ratios[at]
        values.append(v / (np.sqrt(v @ v) or 1.0))
    used = np.flatnonzero(learn)
    w, bias = descend([rows[i] for i in used], [values[i] for i in used], np.where(labels[used], 1.0, -1.0))
    margin = np.array([w[at] @ v + bias for at, v in zip(rows, values, strict=True)])
    test = held if labels[held].any() and not labels[held].all() else learn
    return Model(w, ratios, bias, *calibrate(margin[test], labels[test]))


def held_out(id_col: str = "doc_id"):
    """Rows whose label is never learned from."""
    return F.coalesce(F.crc32(named(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> Model:
    """Fit on the ``max_rows`` labelled rows that may be learned from and have the least hashed ids."""
    sample = (
        labels.select(named(id_col).alias("id"), named(label_col).alias("label"))
        .filter(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    texts = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    chosen = texts.join(F.broadcast(sample), "id")  # max_rows rows at most

    def learn(batches):
        frames = [pdf for pdf in batches if len(pdf)]
        rows = pd.concat(frames) if frames else pd.DataFrame({"text": [], "label": []})
        m = fit(list(rows["text"]), rows["label"].to_numpy() > 0)
        yield pd.DataFrame({"weights": [m.weights.astype(np.float32).tobytes()], "ratios": [m.ratios.astype(np.float32).tobytes()], "bias": [m.bias], "slope": [m.slope], "shift": [m.shift]})

    # rows of one id (repeated documents) are learned once
    ordered = chosen.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label")).repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    got = ordered.mapInPandas(learn, "weights binary, ratios binary, bias double, slope double, shift double").collect()
    if not got:
        return constant(0.5)
    r = got[0]
    return Model(np.frombuffer(r.weights, np.float32), np.frombuffer(r.ratios, np.float32), r.bias, r.slope, r.shift)


def scored(docs: DataFrame, model: Model, text_col: str = "text", result: str = "score") -> DataFrame:
    """``docs`` with a column ``result``: the probability of label 1."""

    def score(texts: pd.Series) -> pd.Series:
        out = [model.scores([t or b"" for _, t in rows]) for rows in R.slabs(((0, t or b"") for t in texts))]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    (name,) = unused(docs, result)
    text = F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.withColumn(name, F.pandas_udf(score, "double")(text)).select(*besides(docs, result), F.col(name).alias(result))


def classify(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` with ``score``."""
    prepared(docs.sparkSession)
    return scored(docs, train(docs, labels, id_col=id_col, text_col=text_col, max_rows=max_rows), text_col)


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.3, text_col: str = "text", id_col: str = "doc_id", max_rows: int = MAX_ROWS) -> DataFrame:
    """Documents that score ``least`` or more, with their own columns."""
    prepared(docs.sparkSession)
    (name,) = unused(docs, "score")
    model = train(docs, labels, id_col=id_col, text_col=text_col, max_rows=max_rows)
    return scored(docs, model, text_col, name).filter(F.col(name) >= least).drop(name)
