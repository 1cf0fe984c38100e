"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Every distinct n-gram (3 to 5 code points, lower case) of the whole text is one binary feature,
hashed into ``BUCKETS``. Its value is the log ratio of its smoothed frequency among toxic and
clean training texts; logistic regression on these values gives the score.

Cases: null or empty text scores as the intercept alone; repeated rows score alike; a table
without usable labels gives every text the score 0; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import class_prior, fold, labelled_sample, text_udf

BUCKETS = 1 << 19
SIZES = (3, 4, 5)
TRAIN_ROWS = 6000  # bound of the labelled sample
LEAST_SHARE = 1 / 500  # an n-gram of a smaller share of the sample (or of one text) carries no weight: its ratio is chance
LEAST_RATIO = 0.25  # nor does one that is about as frequent in both classes
ERRORS = 3.0  # nor one whose ratio lies within this many standard errors of none, which small samples are full of
SCHEMA = T.StructType([T.StructField("score", T.DoubleType())])


def gram_ids(text: str) -> np.ndarray:
    """Bucket of every n-gram of the text, with repeats; a text is framed by one blank on each side."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    parts, hashed = [], points.copy()
    for n in range(2, max(SIZES) + 1):
        if len(points) < n:
            break
        hashed = hashed[:-1] * np.uint32(0x01000193) ^ points[n - 1 :]
        if n in SIZES:
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
            parts.append((mixed ^ (mixed >> np.uint32(12))) & np.uint32(BUCKETS - 1))
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def train(texts: list[str], labels: list[int], prior: float, rounds: int = 60) -> dict:
    """Log-count ratios, then logistic regression by Adam on the scaled binary features."""
    y = np.asarray(labels, dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        return {"weights": np.zeros(BUCKETS, np.float32), "bias": float("-inf")}
    # Counts first, so that only n-grams that carry weight are held for all texts.
    seen = np.zeros((2, BUCKETS), np.int32)
    for text, label in zip(texts, labels):
        seen[label, np.unique(gram_ids(text))] += 1
    ratio = np.log((1 + seen[1]) / (y.sum() + 2)) - np.log((1 + seen[0]) / ((1 - y).sum() + 2))
    least = np.maximum(LEAST_RATIO, ERRORS * np.sqrt(1 / (1 + seen[0]) + 1 / (1 + seen[1])))
    telling = (seen.sum(axis=0) >= max(2, LEAST_SHARE * len(y))) & (np.abs(ratio) >= least)
    ids = [i[telling[i]].astype(np.int32) for i in (np.unique(gram_ids(t)) for t in texts)]
    ends = np.cumsum([0] + [len(i) for i in ids])
    rows = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(ends))
    used, flat = np.unique(np.concatenate(ids), return_inverse=True)
    del ids
    value = ratio[used][flat].astype(np.float32)
    w, bias = np.full(len(used), 0.02), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, rounds + 1):
        sums = np.concatenate([[0.0], np.cumsum(value * w[flat])])
        p = 1 / (1 + np.exp(-np.clip(sums[ends[1:]] - sums[ends[:-1]] + bias, -30, 30)))
        error = (p - y) / len(y)
        g = np.bincount(flat, weights=value * error[rows], minlength=len(used)) + 2e-4 * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        scale = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.03 * (m / scale[0]) / (np.sqrt(v / scale[1]) + 1e-8)
        bias -= 0.08 * (mb / scale[0]) / (np.sqrt(vb / scale[1]) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w * ratio[used]
    # The sample is balanced; the table is not.
    share = y.mean()
    bias += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return {"weights": weights, "bias": float(bias)}


def scorer(model: dict):
    """Score of each text: distinct n-grams are found by marking buckets, without sorting."""
    weights, bias, mark = model["weights"], model["bias"], np.zeros(BUCKETS, np.int64)

    def score(texts: list[str]) -> dict:
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            ids = gram_ids(text)
            at = np.arange(len(ids))
            mark[ids] = at
            once = ids[mark[ids] == at]
            out[k] = bias + weights[once].sum(dtype=np.float64)
        return {"score": 1 / (1 + np.exp(-np.clip(out, -700, 700)))}

    return score


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, parts: int = 4, held: int = 2) -> dict:
    """Train on the rows outside the held-out fold, at most ``rows`` of them."""
    texts, y = labelled_sample(documents, labels, "toxic", parts, held, rows)
    return train(texts, y, class_prior(labels, "toxic", parts, held))


def score_toxicity(documents: DataFrame, model: dict, text_column: str = "text", name: str = "score") -> DataFrame:
    """Adds column ``name`` (replacing one of that name): probability that the whole text is toxic."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    udf = text_udf(SCHEMA, lambda: scorer(shared.value))
    return documents.withColumn(name, udf(F.col(text_column))["score"])


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``."""
    scored = score_toxicity(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select(
        "doc_id",
        fold("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
