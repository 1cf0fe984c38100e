"""Near-duplicate documents by MinHash with tensored banding.

The words of a text (lower case A-Z, split at blanks) give its set of five-word shingles. Two collections
of M half keys, each made of ``HALF`` minhash values, are computed per text: 2 * M * HALF minhashes. Table
(i, j) is keyed by half key i of the first and j of the second collection, which gives M * M tables
of 2 * HALF minhashes each. Two sets of similarity s miss all tables with probability of about
2 * (1 - s**HALF)**M: 4e-4 at 0.85, 1e-5 at 0.9.

No bucket is expanded into pairs. Texts with equal sets are one class first. In each bucket every class is
compared with the bucket's hub (the class with most copies); confirmed links give components. In buckets
that still hold several components, the classes outside the hub's one are compared with the others in blocks
of bounded size by a 512-byte sketch, in the first table both share only; what may reach the similarity is confirmed as well. Every link is
confirmed on the full sets of both texts.

Cases: null and empty texts and texts of white space have no shingle, link with nothing and are kept; a
text of fewer than five words is one shingle; rows repeating an id get the same answer; a null id
takes no part (component null, kept); an empty table gives an empty result; long texts are shingled whole;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import WHITE, small_batches, text_udf

WORDS = 5
HALF, M = 3, 9
BINS = 512
BLOCK = 4096
GROUP_ROWS = 256
BROADCAST_IDS = 1_000_000  # 8 MB of ids
SIGMAS = 5.0
_FACTOR = 0x9E3779B97F4A7C15
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[ord(c) for c in WHITE]] = True

SIGNATURE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("a", T.ArrayType(T.LongType())),
        T.StructField("b", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=4)
def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word, from prefix sums of a polynomial over the bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)  # bytes.lower: A-Z only
    inside = np.concatenate([[False], ~_IS_WHITE[raw], [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = change[::2], change[1::2]
    if len(begin) == 0:
        return np.zeros(0, np.uint64)
    size = 1 << max(14, int(len(raw)).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(_BASE, size)[: len(raw)], dtype=np.uint64)])
    value = (sums[end] - sums[begin]) * powers(_INVERSE, size)[begin]
    return mixed(value + (end - begin).astype(np.uint64) * np.uint64(_FACTOR))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the whole text."""
    words = word_hashes(text)
    if len(words) == 0:
        return words
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    out = words[:n].copy()
    for k in range(1, width):
        out = out * np.uint64(_FACTOR) + words[k : k + n]
    return np.unique(mixed(out + np.uint64(width)))


_SEEDS = np.random.default_rng(20).integers(0, 1 << 63, (2 * M * HALF, 2), dtype=np.uint64)
_MUL, _ADD = (_SEEDS[:, :1] << np.uint64(1)) | np.uint64(1), _SEEDS[:, 1:]


def minhashes(s: np.ndarray) -> np.ndarray:
    """2 * M * HALF minima over the set, in pieces of bounded size."""
    low = np.full(2 * M * HALF, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):
        h = s[None, at : at + 2048] * _MUL + _ADD
        h ^= h >> np.uint64(32)
        low = np.minimum(low, (h * np.uint64(_FACTOR)).min(axis=1))
    return low


def sketch(s: np.ndarray) -> bytes:
    """One byte per bin of the hash space: that of the smallest member, 0 for an empty bin."""
    out = np.zeros(BINS, np.uint8)
    bins, first = np.unique(s >> np.uint64(55), return_index=True)
    out[bins.astype(np.int64)] = mixed(s[first] + np.uint64(1)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def half_keys(low: np.ndarray) -> np.ndarray:
    """(2, M) keys of HALF minhashes each."""
    parts = low.reshape(2, M, HALF)
    key = np.zeros((2, M), np.uint64)
    for k in range(HALF):
        key = mixed(key * np.uint64(_FACTOR) + parts[:, :, k])
    return key


def digests(s: np.ndarray) -> tuple[int, int]:
    return (
        int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)),
        int(np.bitwise_xor.reduce(mixed(s + np.uint64(0x14057B7EF767814F)), initial=0).astype(np.int64)),
    )


def _signatures():
    def run(texts: list[str]) -> dict:
        rows = {f.name: [] for f in SIGNATURE.fields}
        for text in texts:
            s = shingles(text)
            d1, d2 = digests(s)
            key = half_keys(minhashes(s)).astype(np.int64) if len(s) else np.zeros((2, 0), np.int64)
            for name, value in zip(SIGNATURE.names, (len(s), d1, d2, key[0], key[1], sketch(s))):
                rows[name].append(value)
        return {k: pd.Series(v, dtype=object) if k in ("a", "b", "sketch") else v for k, v in rows.items()}

    return run


def may_link(a: np.ndarray, b: np.ndarray, members: np.ndarray, percent: int) -> np.ndarray:
    """Whether sketches (broadcast against each other) leave the similarity possible, with SIGMAS to spare.

    The taken bins are a sample without replacement of the union, which has ``members`` / (1 + s) elements at
    similarity s: for small sets it is nearly the whole union and the estimate nearly exact.
    """
    taken = (a != 0) | (b != 0)
    size = np.maximum(taken.sum(axis=-1), 1)
    same = ((a == b) & taken).sum(axis=-1) / size
    goal = percent / 100
    unseen = np.clip(1 - size / (members / (1 + goal)), 0, 1)
    # Two bytes may be equal by chance, and a union smaller than expected hides up to one element.
    return same >= goal - SIGMAS * np.sqrt(goal * (1 - goal) / size * unseen) - 1 / size


def sketch_filter(percent: int):
    @F.pandas_udf("boolean")
    def passes(x: pd.Series, y: pd.Series, members: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=bool)
        a = np.frombuffer(b"".join(x), np.uint8).reshape(-1, BINS)
        b = np.frombuffer(b"".join(y), np.uint8).reshape(-1, BINS)
        return pd.Series(may_link(a, b, members.to_numpy(), percent))

    return passes


def linked(percent: int):
    """Confirms pairs on the full sets of both texts; a text of another class (its id is repeated) does not count."""

    small_batches()

    @F.pandas_udf("boolean")
    def confirm(tx: pd.Series, ty: pd.Series, dx: pd.Series, dy: pd.Series) -> pd.Series:
        keep = lru_cache(maxsize=64)(lambda t: (s := shingles(t), digests(s)[0]))
        out = []
        for x, y, p, q in zip(tx, ty, dx, dy):
            (a, da), (b, db) = keep(x), keep(y)
            common = len(a) + len(b) - len(np.union1d(a, b))
            out.append(da == p and db == q and common > 0 and 100 * common >= percent * (len(a) + len(b) - common))
        return pd.Series(out, dtype=bool)

    return confirm


def components(edges: DataFrame) -> DataFrame:
    """_node, _root for every node of the edges (_u, _v).

    Each node joins the first of its neighbourhood, edges are contracted to those, until none is left.
    The order is by node number and by a new random number in turn, so stars fall together in
    one round and chains in a logarithmic number of rounds.
    """
    edges = materialize(edges.filter(F.col("_u") != F.col("_v")).distinct())
    steps: list[DataFrame] = []
    while edges.take(1):
        turn = len(steps)
        order = (lambda c: F.col(c)) if turn % 2 == 0 else (lambda c, turn=turn: F.xxhash64(c, F.lit(turn)))
        both = edges.unionByName(edges.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        best = both.groupBy("_u").agg(F.min_by("_v", order("_v")).alias("_first"))
        parent = F.when(order("_first") < order("_u"), F.col("_first")).otherwise(F.col("_u"))
        step = materialize(best.select("_u", parent.alias("_p")))
        steps.append(step)
        one = edges.join(step, "_u").select(F.col("_p").alias("_x"), "_v")
        two = one.join(step.withColumnRenamed("_u", "_v"), "_v").select(F.col("_x").alias("_u"), F.col("_p").alias("_v"))
        edges = materialize(two.filter(F.col("_u") != F.col("_v")).distinct())
    if not steps:
        return edges.select(F.col("_u").alias("_node"), F.col("_v").alias("_root"))
    roots = steps[0].select(F.col("_u").alias("_node"), F.col("_p").alias("_root"))
    for step in steps[1:]:
        up = step.select(F.col("_u").alias("_root"), F.col("_p").alias("_up"))
        roots = roots.join(up, "_root", "left").select("_node", F.coalesce("_up", "_root").alias("_root"))
    return materialize(roots)


def sent_if_few(ids: DataFrame) -> DataFrame:
    """Written distinct ids; up to BROADCAST_IDS of them are sent to the texts, more are met by a shuffle."""
    ids = materialize(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def size_fits(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


class Buckets:
    """Classes of equal sets and their rows in tables that hold more than one class."""

    def __init__(self, documents: DataFrame, percent: int, key: str = "doc_id", text: str = "text"):
        self.percent = percent
        own = documents.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
        self.texts = own.filter(F.col("_id").isNotNull() & F.col("_text").isNotNull())
        signed = own.withColumn("_s", text_udf(SIGNATURE, _signatures)(F.col("_text"))).select("_id", "_s.*")
        self.rows = materialize(signed)
        shingled = self.rows.filter(F.col("_id").isNotNull() & (F.col("n") > 0))
        grouped = shingled.groupBy("d1", "d2", "n").agg(
            F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_copies"), *[F.first(c).alias(c) for c in ("a", "b", "sketch")]
        )
        # Node numbers are unique and ascend with falling number of copies (by powers of two): a hub comes first.
        rank = F.lit(31) - F.least(F.floor(F.log2("_copies")), F.lit(31)).cast("int")
        node = F.shiftleft(rank.cast("long"), 57) + F.monotonically_increasing_id()
        self.classes = materialize(grouped.withColumn("_node", node))

    def keyed(self) -> DataFrame:
        """_k, _node, _t: one row per class and table; _t numbers the tables."""
        table = F.transform("a", lambda x, i: F.transform("b", lambda y, j: F.xxhash64(i, j, x, y)))
        return self.classes.select("_node", F.posexplode(F.flatten(table)).alias("_t", "_k"))

    def crowded(self) -> DataFrame:
        """_k, _node, _hub, _size of the tables' buckets that hold several classes."""
        hubs = self.keyed().groupBy("_k").agg(F.min("_node").alias("_hub"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
        return materialize(self.keyed().join(hubs, "_k"))

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (_u, _v) of nodes whose full sets reach the similarity."""
        side = lambda x: self.classes.select(F.col("_node").alias(f"_{x}"), F.col("n").alias(f"_n{x}"), F.col("d1").alias(f"_d{x}"), F.col("_least").alias(f"_i{x}"), F.col("sketch").alias(f"_s{x}"))
        wide = pairs.distinct().join(side("u"), "_u").join(side("v"), "_v").filter(size_fits("_nu", "_nv", self.percent))
        near = materialize(wide.filter(sketch_filter(self.percent)("_su", "_sv", F.col("_nu") + F.col("_nv"))).drop("_su", "_sv"))
        wanted = near.select(F.col("_iu").alias("_id")).unionByName(near.select(F.col("_iv").alias("_id"))).distinct()
        texts = materialize(self.texts.join(sent_if_few(wanted), "_id", "left_semi"))
        text = lambda x: texts.select(F.col("_id").alias(f"_i{x}"), F.col("_text").alias(f"_t{x}"))
        both = near.join(text("u"), "_iu").join(text("v"), "_iv")
        return materialize(both.filter(linked(self.percent)("_tu", "_tv", "_du", "_dv")).select("_u", "_v").distinct())


def across(percent: int):
    """For a group of block fields: pairs of different components that the sketches leave possible.

    A pair that meets in several tables is looked at in the first of them only.
    """

    def field(x: pd.DataFrame, y: pd.DataFrame, found: list) -> None:
        bits = np.frombuffer(b"".join(y["sketch2"]), np.uint8).reshape(-1, BINS)
        node, n, root = (y[f"{c}2"].to_numpy() for c in ("_node", "n", "_root"))
        a, b, t = np.stack(y["a2"].to_numpy()), np.stack(y["b2"].to_numpy()), x["_t"].iloc[0]
        columns = (x[c].to_numpy() for c in ("_node", "n", "_root", "a", "b", "sketch"))
        for own, size, part, own_a, own_b, raw in zip(*columns):
            at = np.flatnonzero((root != part) & (np.minimum(n, size) * 100 >= np.maximum(n, size) * percent))
            at = at[(a[at] == own_a).argmax(axis=1) * M + (b[at] == own_b).argmax(axis=1) == t]
            if len(at):
                at = at[may_link(np.frombuffer(raw, np.uint8)[None, :], bits[at], n[at] + size, percent)]
                found.append(np.stack([np.minimum(own, node[at]), np.maximum(own, node[at])]))

    def run(seekers: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found: list = [np.zeros((2, 0), np.int64)]
        where = others.groupby(["_k2", "_i2", "_j2"]).indices
        for at, rows in seekers.groupby(["_k", "_i", "_j"]).indices.items():
            if at in where:
                field(seekers.iloc[rows], others.iloc[where[at]], found)
        return pd.DataFrame(np.concatenate(found, axis=1).T, columns=["_u", "_v"])

    return run


def unresolved_pairs(buckets: Buckets, crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs inside a bucket, neither side its hub, that lie in different components."""
    rooted = crowded.filter("_size > 2").join(roots.select(F.col("_node"), F.col("_root").alias("_r")), "_node", "left")
    rooted = materialize(rooted.select("_k", "_t", "_node", "_hub", "_size", F.coalesce("_r", "_node").alias("_root")))
    hub_root = rooted.filter("_node = _hub").select("_k", F.col("_root").alias("_hub_root"))
    rest = rooted.filter("_node <> _hub")
    seekers = materialize(rest.join(hub_root, "_k").filter("_root <> _hub_root").drop("_hub_root", "_hub"))
    extra = buckets.classes.select("_node", "n", "a", "b", "sketch")
    # A bucket's field is cut into blocks of its seekers (_i) and of its others (_j): each side is copied once per
    # block of the other side, so the others only as often as their bucket's seekers fill blocks.
    sizes = materialize(seekers.groupBy("_k").agg(F.count(F.lit(1)).alias("_seekers"), (F.max("_size") - 1).alias("_others")))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    own = lambda count, seed: F.pmod(F.xxhash64("_node", F.lit(seed)), blocks(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), blocks(count) - 1))
    # Many small fields share a group, so the number of groups follows the copied rows of both sides.
    copied = sizes.agg(F.sum(F.col("_seekers") * blocks("_others")).alias("l"), F.sum(F.col("_others") * blocks("_seekers")).alias("r")).first()
    groups = max(1, (copied["l"] or 0) // GROUP_ROWS, (copied["r"] or 0) // (4 * GROUP_ROWS))
    group = F.pmod(F.xxhash64("_k", "_i", "_j"), F.lit(groups))
    columns = ["_f", "_k", "_i", "_j", "_t", "_node", "_root", "n", "a", "b", "sketch"]
    left = seekers.join(sizes, "_k").join(extra, "_node").withColumn("_i", own("_seekers", 1)).withColumn("_j", every("_others")).withColumn("_f", group).select(*columns)
    right = rest.drop("_hub").join(sizes, "_k").join(extra, "_node").withColumn("_j", own("_others", 2)).withColumn("_i", every("_seekers")).withColumn("_f", group)
    right = right.select(*[F.col(c).alias(f"{c}2") for c in columns])  # both sides come from the same tables
    return (
        left.groupBy("_f")
        .cogroup(right.groupBy("_f2"))
        .applyInPandas(across(buckets.percent), "_u long, _v long")
    )


def near_duplicates(documents: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``documents``."""
    buckets = Buckets(documents, percent, key, text)
    crowded = buckets.crowded()
    links = buckets.confirm(crowded.filter("_node <> _hub").select(F.col("_hub").alias("_u"), F.col("_node").alias("_v")))
    roots = components(links)
    more = buckets.confirm(materialize(unresolved_pairs(buckets, crowded, roots)))
    roots = components(links.unionByName(more))
    named = buckets.classes.select("_node", "d1", "d2", F.col("n"), "_least").join(roots, "_node", "left")
    named = named.withColumn("_root", F.coalesce("_root", "_node"))
    least = named.groupBy("_root").agg(F.min("_least").alias("_component"))
    known = materialize(named.join(least, "_root").select("d1", "d2", "n", "_component"))
    out = buckets.rows.select("_id", "n", "d1", "d2").join(known, ["d1", "d2", "n"], "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_component", "_id"))
    return out.select(
        F.col("_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stand for their group, with their own columns; rows repeating an id stay once."""
    found = materialize(near_duplicates(documents, percent, key, text))
    gone = sent_if_few(found.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct())
    kept = documents.join(gone, F.col(key) == F.col("_gone"), "left_anti")
    if found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").take(1):
        named = kept.filter(F.col(key).isNotNull()).dropDuplicates([key])
        return named.unionByName(kept.filter(F.col(key).isNull()))
    return kept
