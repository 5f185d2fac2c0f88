"""Quality classifier from trusted positives and unlabelled text (positive-unlabelled learning).

Negatives are never looked at. With a class prior p, the risk of calling text bad is estimated as
mean over unlabelled of l(-z) minus p times the mean over positives of l(-z); it cannot be negative,
so a step that makes it negative is taken back in favour of raising it. With the logistic loss the
unbiased risk is convex: mean over unlabelled of softplus(z) minus p times the mean of z over
positives. Newton steps minimise it; each step is one Spark job over a small feature table that sums
gradients and curvature over all documents. The driver only holds sums over features.

The prior is estimated from the scores of a first model: the smallest ratio, over thresholds, of the
unlabelled and the positive share above the threshold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import map_texts, query, table, text_key
from fieldlens.llm.language import held_out
from fieldlens.llm.wordscan import Words, gram_hashes
from fieldlens.session import stored

FEATURES = ("words", "word_length", "symbols", "bars", "exclamations", "capitals", "digits", "doubled", "distinct",
            "closed", "lines", "repeated", "beyond_ascii", "longest")
START_PRIOR = 0.5
RIDGE = 1e-3
STEPS = 20
SLACK = 0.02
CUT = 0.3
_KINDS = {"symbols": b"#*$%&<>^~@", "bars": b"|", "exclamations": b"!", "closing": b".,;:?", "lines": b"\n",
          "digits": b"0123456789", "capitals": bytes(range(65, 91)), "beyond_ascii": bytes(range(0xC0, 0x100))}


def text_features(texts: list[str | None]) -> np.ndarray:
    """One row of rates per text, on scales where an ordinary text is near 0 or 1; zeros without words."""
    words = Words(texts)
    n = np.diff(words.first)
    out = np.zeros((len(texts), len(FEATURES)), np.float32)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    hashes = words.hashes()
    begin = words.first[:-1][some]
    count = n[some]
    last = words.first[1:][some] - 1
    byte_begin, byte_end = words.start[begin], words.end[last]
    place = {}
    for name, kind in _KINDS.items():
        marks = np.zeros(256, bool)
        marks[list(kind)] = True
        total = np.concatenate([[0], np.cumsum(marks[words.data])])
        place[name] = (total[byte_end] - total[byte_begin]).astype(float)
        if name == "closing":
            closing = marks[words.data[words.end - 1]]
    size = words.end - words.start
    chars = np.add.reduceat(size, begin).astype(float)
    doubled = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])])
    grams = gram_hashes(hashes, 8)
    distinct, repeated = np.empty(len(some)), np.empty(len(some))
    for k, (a, b) in enumerate(zip(begin, last + 1)):
        distinct[k] = len(np.unique(hashes[a:b])) / (b - a) ** 0.8
        own = grams[a:max(a, b - 7)]
        repeated[k] = 1 - len(np.unique(own)) / len(own) if len(own) else 0
    rate = lambda x, by: np.log1p(20 * x / by)
    values = {"words": np.log1p(count) / 6, "word_length": chars / count / 6, "symbols": rate(place["symbols"], count),
              "bars": rate(place["bars"], count), "exclamations": rate(place["exclamations"], count),
              "capitals": rate(place["capitals"], chars), "digits": rate(place["digits"], chars),
              "doubled": rate(np.add.reduceat(doubled, begin, dtype=float), count), "distinct": distinct,
              "closed": np.add.reduceat(closing, begin, dtype=float) / count * 5, "lines": rate(place["lines"], count),
              "repeated": repeated * 3, "beyond_ascii": rate(place["beyond_ascii"], chars),
              "longest": np.log1p(np.maximum.reduceat(size, begin)) / 3}
    out[some] = np.stack([values[f] for f in FEATURES], axis=1)
    return out


def _feature_rows(cols: list[list]) -> list:
    ids, keys, texts = cols
    return [ids, keys, pa.array(list(text_features(texts)), type=pa.list_(pa.float32()))]


def expanded(x: np.ndarray) -> np.ndarray:
    """A constant, the features, and their squares, all bounded."""
    x = np.clip(x.astype(float), 0, 4)
    return np.hstack([np.ones((len(x), 1)), x, x * x / 4])


WIDTH = 1 + 2 * len(FEATURES)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _sums(weights: np.ndarray):
    """Sums of one task, as (index, value): for unlabelled and positive rows, number, risk, gradients, curvature."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 + 3 * WIDTH + WIDTH * WIDTH)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            x = expanded(flat.reshape(len(batch), len(FEATURES)))
            positive = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            z = x @ weights
            p, risk = _sigmoid(z), np.logaddexp(0, z)
            total += np.concatenate([
                [len(x), positive.sum(), risk.sum(), risk[positive].sum()], p @ x, x[positive].sum(axis=0),
                p[positive] @ x[positive], ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])
    return run


def fit_weights(train: DataFrame, prior: float, weights: np.ndarray | None = None) -> np.ndarray:
    """Weights that minimise the non-negative risk over ``train`` (features, positive)."""
    w = np.zeros(WIDTH) if weights is None else weights
    for _ in range(STEPS):
        rows = train.select("features", "positive").mapInArrow(_sums(w), "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros(4 + 3 * WIDTH + WIDTH * WIDTH)
        total[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
        n, n_pos, risk, risk_pos = total[:4]
        if not n_pos:
            return np.zeros(WIDTH)
        at = 4 + WIDTH * np.arange(4)
        grad_all, mean_pos, grad_pos = (total[a:a + WIDTH] for a in at[:3])
        curvature = total[at[3]:].reshape(WIDTH, WIDTH) / n + RIDGE * np.eye(WIDTH)
        if risk / n - prior * risk_pos / n_pos < 0:  # over-fitted: raise the negative part again
            step = np.linalg.solve(curvature, grad_all / n - prior * grad_pos / n_pos)
        else:
            step = -np.linalg.solve(curvature, grad_all / n - prior * mean_pos / n_pos + RIDGE * w)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        w = w + step
        if np.abs(step).max() < 1e-3:
            break
    return w


def _scores(weights: np.ndarray):
    def run(features):
        x = np.stack(features.to_numpy()) if len(features) else np.zeros((0, len(FEATURES)))
        import pandas as pd
        return pd.Series(_sigmoid(expanded(x) @ weights))
    return F.pandas_udf(run, "double")


def estimate_prior(train: DataFrame, weights: np.ndarray, bins: int = 1000) -> float:
    """Least upper bound of the positives' share: min over thresholds of P(score above) to P(score above | positive).

    Thresholds that keep fewer than a tenth of the positives are too noisy to count.
    """
    score = _scores(weights)(F.col("features"))
    rows = train.select(F.floor(score * (bins - 1)).alias("bin"), F.col("positive").cast("long").alias("p")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p").alias("p")).toArrow()
    everyone, positive = np.zeros(bins), np.zeros(bins)
    everyone[rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    positive[rows.column("bin").to_numpy()] = rows.column("p").to_numpy()
    if not positive.sum():
        return START_PRIOR
    above, above_pos = (np.cumsum(v[::-1]) / v.sum() for v in (everyone, positive))
    use = above_pos >= 0.1
    return float(np.clip((above[use] / above_pos[use]).min() - SLACK, 0.02, 0.98))


def classify(docs: DataFrame, positives: DataFrame, learn) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, score (likelihood of good text, 0 to 1).

    ``positives`` has the doc_ids of trusted good documents; ``learn`` is a condition on doc_id for the
    documents that may be learned from. Null and empty texts have all features 0 and the score that
    belongs to them; without positives every score is 0.5. Repeated rows score alike.
    """
    slim = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    rows, _ = stored(map_texts(slim, _feature_rows, "doc_id long, text_key long, features array<float>"), "features")
    trusted = positives.select(F.col("doc_id").alias("trusted")).filter("trusted IS NOT NULL").distinct()
    train, _ = stored(rows.filter(learn(F.col("doc_id"))).join(trusted, F.col("doc_id") == F.col("trusted"), "left").select(
        "features", F.col("trusted").isNotNull().alias("positive")), "train")
    first = fit_weights(train, START_PRIOR)
    weights = fit_weights(train, estimate_prior(train, first), first)
    return rows.select("doc_id", _scores(weights)(F.col("features")).alias("score"))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    apart = lambda doc_id: held_out(doc_id, 5, 0)
    good = labels.filter(F.col("quality") == 1).filter(~apart(F.col("doc_id")))
    scored = classify(docs, good, lambda doc_id: doc_id.isNotNull() & ~apart(doc_id))
    return scored.select("doc_id", apart(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
