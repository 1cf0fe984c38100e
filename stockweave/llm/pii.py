"""Personal data: candidate spans scored by gradient boosting.

Generators with high recall propose overlapping spans of four kinds: strict ones (the base spans, which
always stay) and loose ones: written-out or spaced addresses, digit runs with any separators. Boosted
trees read the format of a span (digits, groups, separators, checksum, octets, name parts) and its
context (neighbouring characters, words before it). Per kind, the threshold is the smallest score whose
precision on held-out candidates reaches ``PRECISION``; spans above it are added if they overlap no base
span, best first.

Training candidates come from a bounded sample of texts: base spans and rewritten forms of them
(other separators, "name at host dot org") against loose candidates without base span and
broken forms (failing checksum, octets above 255, dates, serial numbers).

Cases: null and empty texts have no spans; long texts are scanned whole in linear time; repeated rows
give the same spans; without any candidate in the sample no span is added; positions are code points,
end exclusive; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_udf

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 24_000  # texts looked at for the sample, about
TRAIN_ROWS = 2000  # bound of the texts in it
PRECISION = 0.98
TREES, DEPTH, BINS, RATE = 40, 3, 24, 0.2

# A digit run begins only where no digit stands before: the leftmost match of the plain pattern does too.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOOSE_NUMBER = re.compile(r"(?<![0-9])[+(]?[0-9](?:[\x20().\-/,:]{0,2}[0-9]){6,}+")
LOOSE_MAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|[(\[]at[)\]]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|[(\[]dot[)\]]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,8}",
    re.I,
)
MAIL_HINT = re.compile(r"@|\(at\)|\[at\]|\x20dot\x20|\(dot\)|\[dot\]", re.I)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write"),
    "ip": ("ip", "host", "address", "server", "from"),
    "card": ("card", "visa", "credit", "account", "iban"),
    "phone": ("tel", "phone", "call", "mobile", "fax"),
}
SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
    ]
)
SPANS = T.StructType([T.StructField("spans", T.ArrayType(SPAN)), T.StructField("base_sha256", T.StringType())])
TEXT = T.StructType([T.StructField("text", T.StringType())])


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octets(s: str) -> bool:
    """Whether all number groups are at most 255 (long ones are compared without conversion)."""
    parts = [p.lstrip("0") for p in re.split(r"[^0-9]+", s) if p]
    return bool(parts) and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Strict spans by kind as listed, then start; leftmost and non-overlapping within a kind."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        found = DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append(("email", begin, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    out += [("ip", *m.span()) for m in IP.finditer(text) if octets(m[0])]
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if 13 <= m.end() - m.start() <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates beyond the base spans; a digit run is proposed as every kind its length allows."""
    out = []
    if MAIL_HINT.search(text):
        out += [("email", *m.span()) for m in LOOSE_MAIL.finditer(text)]
    for m in LOOSE_NUMBER.finditer(text):
        n = len(digits_of(m[0]))
        groups = len(re.findall(r"[0-9]+", m[0]))
        if 13 <= n <= 19:
            out.append(("card", *m.span()))
        if 9 <= n <= 15:
            out.append(("phone", *m.span()))
        if groups == 4 and n <= 12:
            out.append(("ip", *m.span()))
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and its context."""
    s = text[start:end]
    digits = digits_of(s)
    groups = [len(g) for g in re.findall(r"[0-9]+", s)]
    before, after = text[max(0, start - 40) : start], text[end : end + 2]
    words = re.findall(r"[a-z-]+", before.lower())[-4:]
    name, _, domain = s.partition("@")
    return [
        KINDS.index(kind),
        len(s),
        len(digits),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        float(s.startswith("+")),
        float("(" in s or "[" in s),
        s.count(" "),
        s.count("."),
        s.count("-"),
        s.count("/") + s.count(",") + s.count(":"),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(octets(s)),
        float(len(set(groups)) == 1),
        float("@" in s),
        float(bool(re.search(r"\bat\b", s, re.I))) + float(bool(re.search(r"\bdot\b", s, re.I))),
        len(name) if domain else 0,
        len(re.split(r"[^a-z]+", s.lower())[-1]),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in "#$=\"'/_-"),
        float(any(w in CONTEXT[kind] for w in words)),
    ]


def rewritten(kind: str, s: str, rng) -> list[tuple[str, int]]:
    """Other written forms of a base span (label 1) and broken forms of it (label 0)."""
    digits = digits_of(s)
    pick = lambda *x: x[int(rng.integers(len(x)))]
    if kind == "email":
        if rng.random() < 0.5:  # digits in names are a habit of a source, not of addresses
            s = re.sub("[0-9]+", "", s)
        name, _, host = s.partition("@")
        dotted = host.replace(".", pick(" dot ", "(dot)", "[dot]"))
        return [(f"{name} at {dotted}", 1), (f"{name}(at){host}", 1), (f"{name} @ {host}", 1), (f"{name[:3]} at {host[:4]}. Then", 0)]
    if kind == "ip":
        big = ".".join(str(int(p) + 300) for p in s.split("."))
        return [(s.replace(".", " . "), 1), (s.replace(".", ", "), 0), (big, 0), (f"{digits[:2]}.{digits[2:4]}.20{digits[-2:]}", 0)]
    if kind == "card":
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + int(rng.integers(8))) % 10)
        return [(pick(" - ", ".", "  ").join(four), 1), (wrong, 0), ("".join(map(str, rng.integers(0, 10, 16))), 0)]
    return [
        (f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", 1),
        (f"{digits[:3]}-{digits[3:6]}-{digits[6:]}", 1),
        (digits, 0),
        (f"20{digits[:2]}-{digits[2:4]}-{digits[4:6]} {digits[6:8]}:{digits[8:10]}:00", 0),
    ]


def training_rows(texts: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    x, y = [], []
    for text in texts:
        base = base_spans(text)
        for kind, a, b in base:
            x.append(features(text, kind, a, b))
            y.append(1)
            for form, label in rewritten(kind, text[a:b], rng):
                changed = text[max(0, a - 40) : a] + form + text[b : b + 2]
                at = min(a, 40)
                x.append(features(changed, kind, at, at + len(form)))
                y.append(label)
        for kind, a, b in loose_spans(text):
            if not any(a < e and s < b for _, s, e in base):
                x.append(features(text, kind, a, b))
                y.append(0)
    width = len(features("", "email", 0, 0))
    return np.array(x, float).reshape(len(y), width), np.array(y, float)


def grow(binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[list, np.ndarray]:
    """One tree of DEPTH levels: (feature, bin) per inner node in level order, and leaf values."""
    node = np.zeros(len(g), np.int64)
    splits: list[tuple[int, int]] = []
    for level in range(DEPTH):
        first = 2**level - 1
        for k in range(first, 2 * first + 1):
            rows = node == k
            best = (1e-6, 0, BINS)  # all rows left
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for f in range(binned.shape[1]):
                gl = np.cumsum(np.bincount(binned[rows, f], g[rows], BINS))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, f], h[rows], BINS))[:-1]
                gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
                at = int(gain.argmax())
                if gain[at] > best[0] + 1e-9:
                    best = (gain[at], f, at)
            splits.append(best[1:])
            node[rows] = 2 * k + 1 + (binned[rows, best[1]] > best[2])
    leaf = node - (2**DEPTH - 1)
    return splits, -np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)


def bins_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)


def add_up(model: dict, x: np.ndarray) -> np.ndarray:
    binned = bins_of(x, model["edges"])
    total = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for splits, leaves in model["trees"]:
        node = np.zeros(len(x), np.int64)
        table = np.array(splits)
        for _ in range(DEPTH):
            f, at = table[node].T
            node = 2 * node + 1 + (binned[rows, f] > at)
        total += RATE * leaves[node - (2**DEPTH - 1)]
    return total


def train(texts: list[str]) -> dict | None:
    """Trees on two thirds of the candidates, thresholds on the rest; None without both labels."""
    x, y = training_rows(texts)
    if len(y) < 30 or y.min() == y.max():
        return None
    held = np.random.default_rng(5).random(len(y)) < 1 / 3
    a, b = x[~held], y[~held]
    edges = [np.unique(np.quantile(a[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = bins_of(a, edges)
    model = {"edges": edges, "trees": [], "start": float(np.log((b.mean() + 1e-3) / (1 - b.mean() + 1e-3)))}
    total = np.full(len(b), model["start"])
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        splits, leaves = grow(binned, p - b, p * (1 - p))
        model["trees"].append((splits, leaves))
        total = add_up(model, a)
    model["thresholds"] = thresholds(x[held], y[held], add_up(model, x[held]))
    return model


def thresholds(x: np.ndarray, y: np.ndarray, score: np.ndarray) -> list[float]:
    """Per kind, the least score from which on precision is at least PRECISION; infinite if none."""
    out = []
    for k in range(len(KINDS)):
        own = x[:, 0] == k
        order = np.argsort(-score[own], kind="stable")
        s, good = score[own][order], y[own][order]
        precise = np.cumsum(good) / np.arange(1, len(good) + 1) >= PRECISION
        last_of_tie = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, bool)
        fit_for = np.flatnonzero(precise & last_of_tie)
        out.append(float(max(s[fit_for[-1]], 0.0)) if len(fit_for) else float("inf"))
    return out


def detect(text: str, model: dict | None) -> list[tuple[str, int, int, bool, float]]:
    """All spans by kind as listed, then start: base spans, and the selected candidates beside them."""
    base = base_spans(text)
    out = [(k, a, b, True, 1.0) for k, a, b in base]
    loose = [c for c in loose_spans(text) if not any(c[1] < e and s < c[2] for _, s, e in base)] if model else []
    if loose:
        score = add_up(model, np.array([features(text, *c) for c in loose], float))
        taken: list[tuple[int, int]] = []
        for i in sorted(range(len(loose)), key=lambda i: (-score[i], loose[i][1], loose[i][0])):
            kind, a, b = loose[i]
            if score[i] >= model["thresholds"][KINDS.index(kind)] and not any(a < e and s < b for s, e in taken):
                taken.append((a, b))
                out.append((kind, a, b, False, float(1 / (1 + np.exp(-score[i])))))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def redact(text: str, model: dict | None) -> str:
    """The text with every span (overlapping ones as one) replaced by the kind of its first."""
    out, done = [], 0
    for kind, a, b, *_ in sorted(detect(text, model), key=lambda s: (s[1], KINDS.index(s[0]))):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def fit(documents: DataFrame, rows: int = TRAIN_ROWS, text: str = "text", key: str = "doc_id") -> dict | None:
    """Model from at most ``rows`` texts that hold a digit run or an address, in the order of a hash of their id."""
    place = F.pmod(F.xxhash64(key, F.lit(9)), F.lit(1 << 30))
    cut = min(1 << 30, SAMPLE_ROWS * (1 << 30) // max(1, documents.count()))
    useful = documents.filter(place < cut).filter(F.col(text).rlike(r"@|[0-9][0-9 .\-]{6,}[0-9]"))
    return train([r[0] for r in useful.orderBy(place, key, text).limit(rows).select(text).collect()])


def _span_rows(model):
    def run(texts: list[str]) -> dict:
        found = [detect(t, model) for t in texts]
        return {
            "spans": pd.Series([[dict(zip(SPAN.names, s)) for s in f] for f in found], dtype=object),
            "base_sha256": [hashlib.sha256(joined(s for s in f if s[3]).encode()).hexdigest() for f in found],
        }

    return run


def find_spans(documents: DataFrame, model: dict | None, text: str = "text", name: str = "spans") -> DataFrame:
    """Adds the struct column ``name``: spans and the digest of the base spans."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return documents.withColumn(name, text_udf(SPANS, lambda: _span_rows(shared.value))(F.col(text)))


def redact_text(documents: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """Replaces the column by its redacted form; null stays null."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    udf = text_udf(TEXT, lambda: lambda texts: {"text": [redact(t, shared.value) for t in texts]})
    return documents.withColumn(text, F.when(F.col(text).isNotNull(), udf(F.col(text))["text"]))


def _count(kind: str) -> Column:
    return F.size(F.filter("_s.spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, digest of the base spans, all spans as text, number added."""
    found = find_spans(documents.select("doc_id", "text"), fit(documents), name="_s")
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return found.select(
        "doc_id",
        *[_count(k) for k in KINDS],
        F.col("_s.base_sha256").alias("base_sha256"),
        F.array_join(F.transform("_s.spans", one), ",").alias("spans"),
        F.size(F.filter("_s.spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
