"""Quality classifier by positive-unlabelled learning.

Trusted positives are the labelled good documents, the unlabelled set is web
text of any kind; labelled bad documents are not used.  The share of good
documents among the unlabelled (the class prior) is estimated from the scores
of a first classifier, then a linear model minimises the non-negative unbiased
risk ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``.  Both samples are
bounded by parameters; scoring covers every whole text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import NON_SPACE, U, chunks, ship, words

#: Hashed byte n-grams (pairs and triples), then shares of kinds of bytes, words and lines.
GRAMS, SHARES = 512, 10
FEATURES = GRAMS + SHARES
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_SIGN = np.array([0x21 <= b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7E for b in range(256)])
_PLAIN_SIGN = np.array([chr(b) in ".,;:'\"-()?" for b in range(256)])


def features(chunk) -> np.ndarray:
    """One row of :data:`FEATURES` values per text, all between 0 and 2; an empty text has zeros."""
    rows, data, offsets = chunk.rows, chunk.data, chunk.offsets
    out = np.zeros((rows, FEATURES), np.float32)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(rows), sizes)
    share = np.maximum(sizes, 1)
    counts = np.zeros(rows * GRAMS)
    code = data.astype(np.uint32)
    for n, salt in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        if len(code) < n:
            continue
        whole = code[:len(code) - n + 1].copy()
        for i in range(1, n):
            whole = whole * np.uint32(257) + code[i:len(code) - n + 1 + i]
        within = owner[:len(whole)] == owner[n - 1:]
        slot = (whole * np.uint32(salt)) >> np.uint32(32 - GRAMS.bit_length() + 1)
        counts += np.bincount(owner[:len(whole)][within] * GRAMS + slot[within], minlength=rows * GRAMS)
    counts = counts.reshape(rows, GRAMS)
    out[:, :GRAMS] = 4 * np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1) / 2)
    if not len(data):
        return out

    def of_bytes(mask):
        return np.bincount(owner[mask[data]], minlength=rows) / share

    w = words(chunk, NON_SPACE, True)
    n_words = np.bincount(w.row, minlength=rows)
    per_word = np.maximum(n_words, 1)
    distinct = np.unique(np.stack([w.row.astype(U), w.hash]), axis=1)[0].astype(np.int64) if len(w.row) else w.row
    same = (w.row[1:] == w.row[:-1]) & (w.hash[1:] == w.hash[:-1])
    ends = np.flatnonzero(data == 10)
    values = [
        of_bytes(_UPPER), of_bytes(_DIGIT), of_bytes(_SIGN), of_bytes(_SIGN & ~_PLAIN_SIGN), of_bytes(~NON_SPACE),
        np.bincount(distinct, minlength=rows) / per_word,
        np.bincount(w.row[1:][same], minlength=rows) / per_word,
        np.minimum(np.bincount(w.row, w.end - w.start, rows) / per_word / 20, 2),
        np.log1p(n_words) / 10,
        np.bincount(owner[ends], minlength=rows) / per_word,
    ]
    out[:, GRAMS:] = np.stack(values, axis=1)
    return out


def _features(batches):
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            x = features(chunk)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(chunk.first, chunk.rows), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "x"])


#: The estimated prior is an upper bound; this share of it is used.
UPPER = 0.98


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def _descend(gradient, steps: int, rate: float) -> np.ndarray:
    """Adam from zero, its rate falling to zero; ``gradient(weights with bias last, step)``."""
    w, m, v = (np.zeros(FEATURES + 1, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        g = gradient(w, t).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - np.float32(rate * (1 - t / steps)) * (m / np.float32(1 - 0.9**t)) / (np.sqrt(v / np.float32(1 - 0.999**t)) + np.float32(1e-8))
    return w


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of a positive-against-unlabelled classifier.

    At the best threshold, the unlabelled scores above it are nearly all positives: the smallest ratio of
    the two exceedance shares, each with its sampling error, bounds the prior.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.9, 60))
    p = (positive[None] >= cuts[:, None]).mean(1)
    u = (unlabelled[None] >= cuts[:, None]).mean(1)
    error = np.sqrt(np.log(20) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = int(np.argmin((u + error) / p))
    return float(np.clip(u[best] / p[best], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = 1000, batch: int = 2048,
        rate: float = 0.03, decay: float = 1e-4, seed: int = 7) -> Model:
    """Non-negative PU risk with the logistic loss; ``prior`` is estimated when not given.

    Without positives or without unlabelled rows nothing can be learned: every score is then 0.5.
    """
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(FEATURES), 0.0, prior if prior is not None else 0.5)
    rng = np.random.RandomState(seed)

    def draw(x):
        return x[rng.randint(0, len(x), min(batch, len(x)))]

    def mean(x, slope):
        """Gradient of the mean loss whose slope in the margin is ``slope`` for each row."""
        return np.append(slope @ x, slope.sum()) / len(x)

    if prior is None:
        held = rng.rand(len(positive)) < 0.25
        held[:1], held[-1:] = True, len(positive) == 1
        known = positive[~held] if (~held).any() else positive

        def apart(w, _):
            p, u = draw(known), draw(unlabelled)
            return mean(p, -_sigmoid(-(p @ w[:-1] + w[-1]))) + mean(u, _sigmoid(u @ w[:-1] + w[-1])) + decay * w

        w = _descend(apart, steps // 4, rate)
        prior = UPPER * estimate_prior(positive[held] @ w[:-1], unlabelled @ w[:-1])

    def risk(w, _):
        p, u = draw(positive), draw(unlabelled)
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        of_negative = mean(u, _sigmoid(zu)) - prior * mean(p, _sigmoid(zp))
        if negative < 0:                               # over-fitted: step back on the negative risk alone
            return -of_negative + decay * w
        return -prior * mean(p, _sigmoid(-zp)) + of_negative + decay * w

    w = _descend(risk, steps, rate)
    return Model(w[:-1], float(w[-1]), prior)


def held_out(id_col: str = "doc_id"):
    """Rows whose crc32 of the id as text is divisible by 5 are never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def sample_features(df: DataFrame, keys: DataFrame, n: int, id_col: str, text_col: str) -> np.ndarray:
    """Features of the ``n`` rows of ``keys`` (a column of distinct ids) that come first by a hash of the id."""
    chosen = keys.select(F.col(id_col).alias("id")).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(n)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id", "left_semi")
    kind = df.schema[id_col].dataType.simpleString()
    rows = docs.mapInArrow(_features, f"id {kind}, x binary").orderBy(F.xxhash64(F.col("id").cast("string")), "id", "x").limit(n).collect()
    return np.array([np.frombuffer(r.x, np.float32) for r in rows], np.float32).reshape(len(rows), FEATURES)


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_positive: int = 6000, max_unlabelled: int = 12000) -> Model:
    """A model from at most ``max_positive`` trusted positives and ``max_unlabelled`` rows of ``df``.

    Positives are ids of ``labels`` with label 1 (and never 0) outside the held-out part; labels that are
    null are ignored.  The bounds keep what reaches the driver (2 kB a row) the same at every input size.
    """
    ship(df.sparkSession)
    good = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
            .groupBy(id_col).agg(F.min(label_col).alias("least")).where(F.col("least") == 1).select(id_col))
    web = df.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(id_col).distinct()
    return fit(sample_features(df, good, max_positive, id_col, text_col), sample_features(df, web, max_unlabelled, id_col, text_col))


def _score(model: Model):
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows), pa.array(model.score(features(chunk)), pa.float64())], ["id", "score"])
    return run


def _carry(model: Model, n_columns: int):
    def run(batches):
        for batch in batches:
            text = batch.column(n_columns)
            scores = np.concatenate([model.score(features(c)) for c in chunks(text)]) if len(text) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_columns], pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:n_columns], "score"])
    return run


def score_texts(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` (0 to 1, higher: more likely good) for every row; null and empty texts score as empty."""
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _score(model), f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """Rows of ``df``, all columns as they are, whose text scores at least ``threshold``."""
    from pyspark.sql import types as T

    ship(df.sparkSession)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = df.columns.index(text_col)
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    scored = plain.select("*", F.col(f"c{at}").alias("text")).mapInArrow(_carry(model, len(df.columns)), schema)
    return scored.where(F.col("score") >= threshold).drop("score").toDF(*df.columns)
