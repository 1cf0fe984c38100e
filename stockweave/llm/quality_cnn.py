"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of the whole text are embedded; learned filters of ``WIDTH`` bytes are evaluated at
every ``STEP``-th byte. Their maxima over ``HALF`` bytes are joined in pairs, which gives chunks of
2 * HALF bytes that overlap by half and cover the whole text. A small layer reads each chunk;
its maxima and means over all chunks are combined into one probability. Low maxima of most
filters show a chunk of few different words, so repetition is visible, not only odd symbols.

A score is a function of its text alone: filters at a text's end read zeros, and the fitted net is rounded to a grid on
which sums are exact, so neighbours, order and partitioning change no bit.

Cases: null or empty text is one chunk of padding and gets a score as any other; long texts are
read to the end in pieces of bounded size, with the score of the whole; repeated rows score alike; without labels of both
classes every text scores 0.5; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import class_prior, fold, labelled_sample, text_udf

DIM, WIDTH, STEP, FILTERS, HIDDEN = 4, 8, 4, 32, 16
HALF = 256
PER_HALF = HALF // STEP
TRAIN_ROWS = 2400  # bound of the labelled sample
GROUP_BYTES = 1 << 18
SCHEMA = T.StructType([T.StructField("score", T.DoubleType())])


def halves(text: str) -> np.ndarray:
    """The text's bytes, padded with zeros to whole halves, two at least."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(2, -(-len(raw) // HALF)) * HALF
    return np.frombuffer(raw.ljust(size, b"\0"), dtype=np.uint8)


def initial(seed: int = 7) -> dict:
    rng = np.random.default_rng(seed)
    return {
        "e": rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
        "w": rng.normal(0, (2 / (WIDTH * DIM)) ** 0.5, (WIDTH * DIM, FILTERS)).astype(np.float32),
        "b": np.zeros(FILTERS, np.float32),
        "h": rng.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)).astype(np.float32),
        "c": np.zeros(HIDDEN, np.float32),
        "o": rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32),
        "d": np.zeros(1, np.float32),
    }


def exact(net: dict) -> dict:
    """The net on a grid so coarse that every sum of a score up to the chunks' layer is exact.

    Sums of exact terms do not depend on their order, so a text scores the same to the last bit whatever the
    size of the group and the library's blocking of a product.
    """
    on = lambda x, bits: np.clip(np.round(x * 2.0**bits), -(2.0 ** (bits + 2)), 2.0 ** (bits + 2)) / 2.0**bits
    small = {"e": on(net["e"], 6), "w": on(net["w"], 8), "b": on(net["b"], 14)}
    return {k: x.astype(np.float32) for k, x in small.items()} | {k: on(net[k], 12).astype(float) for k in "hc"} | {k: net[k].astype(float) for k in "od"}


def windows(net: dict, data: np.ndarray) -> np.ndarray:
    """One row of WIDTH * DIM values per filter position."""
    flat = np.ascontiguousarray(net["e"][data]).reshape(-1)
    n, item = (len(data) - WIDTH) // STEP + 1, flat.itemsize
    return as_strided(flat, (n, WIDTH * DIM), (STEP * DIM * item, item))


def forward(net: dict, parts: list[np.ndarray], after: np.ndarray = np.zeros(WIDTH - STEP, np.uint8)) -> dict:
    """All layers for a group of texts.

    The last filter of a text reads the bytes ``after`` (zeros, or what follows a piece of a longer
    text), never those of its neighbour.
    """
    data = np.concatenate([x for p in parts for x in (p, after)])
    rows = windows(net, data)
    count = np.array([len(p) // HALF for p in parts])
    # Positions that begin in ``after`` belong to no text.
    place = np.arange(count.sum() * PER_HALF) + np.repeat(np.arange(len(parts)), count * PER_HALF) * (len(after) // STEP)
    act = np.maximum(rows[place] @ net["w"] + net["b"], 0).reshape(-1, PER_HALF, FILTERS)
    half = act.max(axis=1)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    keep = np.ones(len(half), bool)
    keep[first + count - 1] = False  # a chunk starts at every half but a text's last
    at = np.flatnonzero(keep)
    chunk = np.maximum(half[at], half[at + 1]).astype(net["h"].dtype)
    hidden = np.maximum(chunk @ net["h"] + net["c"], 0)
    n = count - 1
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    top, mean = np.maximum.reduceat(hidden, starts), np.add.reduceat(hidden, starts) / n[:, None]
    z = answer(net, top, mean)
    return {"data": data, "rows": rows, "place": place, "act": act, "half": half, "at": at, "chunk": chunk, "hidden": hidden, "n": n, "starts": starts, "top": top, "mean": mean, "p": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}


def answer(net: dict, top: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The last layer, summed row by row: its rounding does not depend on the number of rows."""
    return (np.concatenate([top, mean], axis=1) * net["o"]).sum(axis=1) + net["d"]


def gradients(net: dict, f: dict, y: np.ndarray) -> dict:
    """Back through the maxima: only the positions that gave them receive a gradient."""
    g = {}
    gz = ((f["p"] - y) / len(y)).astype(np.float32)
    g["o"], g["d"] = np.concatenate([f["top"], f["mean"]], axis=1).T @ gz, gz.sum(keepdims=True)
    gtop, gmean = gz[:, None] * net["o"][:HIDDEN], gz[:, None] * net["o"][HIDDEN:]
    doc = np.repeat(np.arange(len(y)), f["n"])
    gh = gmean[doc] / f["n"][doc][:, None]
    gh += np.where(f["hidden"] == f["top"][doc], gtop[doc], 0)
    gh *= f["hidden"] > 0
    g["h"], g["c"] = f["chunk"].T @ gh, gh.sum(axis=0)
    gc = gh @ net["h"].T
    left = f["half"][f["at"]] >= f["half"][f["at"] + 1]
    ghalf = np.zeros_like(f["half"])
    np.add.at(ghalf, f["at"], np.where(left, gc, 0))
    np.add.at(ghalf, f["at"] + 1, np.where(left, 0, gc))
    ghalf *= f["half"] > 0
    k, j = np.nonzero(ghalf)
    where = f["place"][k * PER_HALF + f["act"].argmax(axis=1)[k, j]]
    value = ghalf[k, j]
    read = f["rows"][where]
    g["w"] = np.stack([value[j == x] @ read[j == x] for x in range(FILTERS)], axis=1)
    g["b"] = np.bincount(j, weights=value, minlength=FILTERS).astype(np.float32)
    back = (value[:, None] * net["w"].T[j]).reshape(-1, WIDTH, DIM)
    byte = f["data"][where[:, None] * STEP + np.arange(WIDTH)].reshape(-1)
    flat = back.reshape(-1, DIM)
    g["e"] = np.stack([np.bincount(byte, weights=flat[:, d], minlength=256) for d in range(DIM)], axis=1)
    return g


def train(texts: list[str], labels: list[int], prior: float, epochs: int = 10, batch: int = 32, rate: float = 4e-3) -> dict | None:
    """Adam over minibatches; None if the sample lacks a class."""
    y = np.asarray(labels, dtype=np.float32)
    if len(y) == 0 or y.min() == y.max():
        return None
    net, rng = initial(), np.random.default_rng(11)
    parts = [halves(t) for t in texts]
    m = {k: np.zeros_like(x) for k, x in net.items()}
    v = {k: np.zeros_like(x) for k, x in net.items()}
    step, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            pick = order[at : at + batch]
            f = forward(net, [parts[i] for i in pick])
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for k, g in gradients(net, f, y[pick]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                net[k] = (net[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    share = float(y.mean())
    net["d"] = net["d"] + np.float32(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return exact(net)


def scorer(net: dict | None):
    def score(texts: list[str]) -> dict:
        out = np.full(len(texts), 0.5)
        if net is None:
            return {"score": out}
        group, size, begin = [], 0, 0
        for k, text in enumerate(texts):
            group.append(halves(text))
            size += len(group[-1])
            if size >= GROUP_BYTES or k == len(texts) - 1:
                out[begin : k + 1] = probabilities(net, group)
                group, size, begin = [], 0, k + 1
        return {"score": out}

    return score


def probabilities(net: dict, parts: list[np.ndarray]) -> np.ndarray:
    """Scores of a group; a very long text is pooled piece by piece, wherever it stands."""
    out, short = np.zeros(len(parts)), [k for k, p in enumerate(parts) if len(p) <= 4 * GROUP_BYTES]
    if short:
        out[short] = forward(net, [parts[k] for k in short])["p"]
    for k in sorted(set(range(len(parts))) - set(short)):
        out[k] = long_probability(net, parts[k])
    return out


def long_probability(net: dict, data: np.ndarray) -> float:
    """The score of a whole text from pieces that share a half and read into the next piece, as the whole would."""
    top, total, n = np.zeros(HIDDEN), np.zeros(HIDDEN), 0
    padded = np.concatenate([data, np.zeros(WIDTH - STEP, np.uint8)])
    for at in range(0, len(data) - HALF, GROUP_BYTES):
        end = min(at + GROUP_BYTES + HALF, len(data))
        f = forward(net, [data[at:end]], padded[end : end + WIDTH - STEP])
        top, total, n = np.maximum(top, f["top"][0]), total + f["hidden"].sum(axis=0), n + len(f["hidden"])
    z = answer(net, top[None], (total / n)[None])
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30)))[0])


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, parts: int = 3, held: int = 1) -> dict | None:
    texts, y = labelled_sample(documents, labels, "quality", parts, held, rows)
    return train(texts, y, class_prior(labels, "quality", parts, held))


def score_quality(documents: DataFrame, net: dict | None, text_column: str = "text", name: str = "score") -> DataFrame:
    """Adds column ``name`` (replacing one of that name): probability of label 1 for the whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(net)
    udf = text_udf(SCHEMA, lambda: scorer(shared.value))
    return documents.withColumn(name, udf(F.col(text_column))["score"])


def quality(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``."""
    scored = score_quality(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select(
        "doc_id",
        fold("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
