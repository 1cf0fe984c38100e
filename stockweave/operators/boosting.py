"""Boosted regression trees of second order on quantile-binned columns.

Columns are cut at quantiles once; rows keep bin numbers, packed into blocks of about ``BLOCK`` rows, one table row each.
A tree grows level by level: each task adds up gradient and Hessian per (node, feature, bin) of its rows, one shuffle
brings the sums of a node together, and running sums along the bins give every split's gain

    T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2), halved, less gamma

where T shrinks a gradient by the L1 penalty. Only the best split per node reaches the driver. Nodes of at most
``NODE_ROWS`` rows are sent to one task each, which grows the rest of their subtree from the same sums; larger ones
are never gathered. Several models (the trials of a search) grow in the same passes over the rows.

A round's trees are added to the margins of all rows once: the new table is persisted, and every ``KEPT_TREES`` rounds
written, so no lineage grows. A row is drawn for a tree by a hash of its content: the same rows for every partitioning,
equal rows together.

From ``HELD_ROUNDS`` rounds on, rows that fit are held by the tasks of one stage, which grow all trees without reading
them again: a task holds a share of the rows and tells the others its sums once per level (a barrier stage), or, where
deep trees make these sums large, each model has a task of its own. Only the smaller child of a split node is counted;
the other is what is left of the node. The trees are those of the passes over stored rows.

Missing features lie below every value; rows without a target or with a weight that is null or not above 0 teach
nothing. No usable row raises.
"""

from __future__ import annotations

import itertools
import os
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, materialize, scratch_path

BINS = 64
NODE_ROWS = 1 << 20
TASK_ROWS = 262_144
BLOCK = 32_768
KEPT_TREES = 25
SPAN = 1 << 20
HELD_ROUNDS = 8
HELD_BYTES = 400 << 20  # of rows that one task holds at most
FEW_ROWS = 1 << 17
TOLD = 1 << 27  # bytes of sums that all tasks together tell each other in a round, at most
PART = 1 << 17  # held rows that are routed and counted at once
EQUAL = 1e-9  # relative difference of gains that counts as a tie


@dataclass(frozen=True)
class TreeSettings:
    eta: float = 0.3
    max_depth: int = 6
    min_child_weight: float = 1.0
    gamma: float = 0.0
    alpha: float = 0.0
    l2: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0


@dataclass
class Tree:
    """Nodes by heap number (root 1, children 2n and 2n + 1); ``feature`` -1 is a leaf, bins up to ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 << depth
        return cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf (or unsplit node) of each column of ``bins`` (features x rows)."""
        at, rows, flat = np.ones(bins.shape[1], np.int64), np.arange(bins.shape[1]), bins.ravel()
        while True:
            feature = self.feature.take(at)
            inner = feature >= 0
            if not inner.any():
                return at
            right = flat.take(np.maximum(feature, 0) * bins.shape[1] + rows) > self.cut.take(at)
            at = np.where(inner, 2 * at + right, at)

    def whole(self) -> Tree:
        """The same answers with all leaves at one depth: rows of an earlier leaf go on to the left."""
        inner = np.nonzero(self.feature >= 0)[0]
        depth = int(inner.max()).bit_length() if len(inner) else 0
        out = Tree(*[np.resize(x, 2 << depth).copy() for x in (self.feature, self.cut, self.value)])
        for level in range(depth):
            nodes = np.arange(1 << level, 2 << level)
            leaves = nodes[out.feature[nodes] < 0]
            out.value[2 * leaves] = out.value[leaves]
            out.feature[2 * leaves] = -1
            out.feature[leaves], out.cut[leaves] = 0, np.iinfo(np.int32).max
        return out

    def answers(self, bins: np.ndarray) -> np.ndarray:
        """The value of each column of ``bins``; for a tree made ``whole``."""
        n = bins.shape[1]
        at, rows, flat, first = np.ones(n, np.int64), np.arange(n), bins.ravel(), self.feature.astype(np.int64) * n
        for _ in range(len(self.feature).bit_length() - 2):
            right = flat.take(first.take(at) + rows) > self.cut.take(at)
            at += at
            at += right
        return self.value.take(at)


# ------------------------------------------------------------ bins


def column_cuts(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Ascending cuts per column: its values if there are at most ``bins``, else quantiles; -inf first if any is missing."""
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    few = rows.agg(*[F.approx_count_distinct(value(c), 0.02).alias(f"n{i}") for i, c in enumerate(features)]).first()
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    exact = [few[f"n{i}"] <= bins for i in range(len(features))]
    aggs = []
    for i, c in enumerate(features):
        points = F.collect_set(value(c)) if exact[i] else F.percentile_approx(value(c), shares, F.lit(10_000))
        aggs += [points.alias(f"c{i}"), F.count(F.when(value(c).isNull(), 1)).alias(f"m{i}")]
    found = rows.agg(*aggs).first()
    return [([-np.inf] if found[f"m{i}"] else []) + sorted(set(found[f"c{i}"] or [])) for i in range(len(features))]


def bin_type(cuts: list[list[float]]) -> str:
    return "u1" if max(map(len, cuts)) < 256 else "<i4"


def binned(rows: DataFrame, target: str, features: Sequence[str], cuts: list[list[float]], weight: str | None, margins: list[float], n_rows: int) -> DataFrame:
    """Blocks of rows, written: bins (features x rows), y, w, u (a hash of the content) and one margin per model, as bytes."""
    values = [F.col(c).cast("double").alias(f"b{i}") for i, c in enumerate(features)]
    heavy = F.col(weight).cast("double") if weight else F.lit(1.0)
    plain = rows.select(*values, F.col(target).cast("double").alias("_y"), heavy.alias("_w"))
    plain = plain.filter("_y is not null and not isnan(_y) and _w > 0").withColumn("_u", F.xxhash64(*plain.columns))
    # Every round reads these partitions: alike in size, a multiple of the cores, more of them for more rows.
    cores = plain.sparkSession.sparkContext.defaultParallelism
    plain = plain.repartition(cores * -(-n_rows // (cores * TASK_ROWS)))
    names, kind = [f"m{t}" for t in range(len(margins))], bin_type(cuts)

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        own = pa.Table.from_batches(parts)
        column = lambda c: own.column(c).to_numpy()
        place = lambda c, x: np.searchsorted(c, np.nan_to_num(x.astype(float), nan=-np.inf, posinf=np.inf, neginf=-np.inf))
        bins = np.stack([place(c, column(f"b{i}")) for i, c in enumerate(cuts)]).astype(kind)
        out = [bins, column("_y"), column("_w"), column("_u"), *[np.full(len(own), m) for m in margins]]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in out], ["bins", "y", "w", "u", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            parts.append(batch)
            if sum(map(len, parts)) >= BLOCK:
                yield block(parts)
                parts = []
        if sum(map(len, parts)):
            yield block(parts)

    return materialize(plain.mapInArrow(run, ", ".join(f"{c} binary" for c in ["bins", "y", "w", "u", *names])))


def blocks(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple]:
    """Bins, target, weight, hash and the margin of each model that was read."""
    for batch in batches:
        models = [int(c[1:]) for c in batch.schema.names[4:]]
        for i in range(len(batch)):
            bins, *rest = [c[i].as_buffer() for c in batch.columns]
            y, w, u, *margins = [np.frombuffer(x, "<i8" if k == 2 else "<f8") for k, x in enumerate(rest)]
            yield np.frombuffer(bins, kind).reshape(-1, len(y)), y, w, u, dict(zip(models, margins))


def read_for(state: DataFrame, models: Sequence[int]) -> DataFrame:
    return state.select("bins", "y", "w", "u", *[f"m{t}" for t in models])


# ------------------------------------------------------------ gains


def shrunk(g, alpha):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_value(g: float, h: float, s: TreeSettings) -> float:
    return float(-s.eta * shrunk(g, s.alpha) / (h + s.l2))


def best_splits(g: np.ndarray, h: np.ndarray, s: TreeSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and bin of each node's best split, from sums (nodes x features x bins); a gain of 0 or less is none."""
    gl, hl = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    ga, ha = gl[:, :, -1:], hl[:, :, -1:]
    part = lambda x, y: shrunk(x, s.alpha) ** 2 / (y + s.l2)
    gain = (part(gl, hl) + part(ga - gl, ha - hl) - part(ga, ha)) / 2 - s.gamma
    # A side without rows is no side: sums of weights may leave a rest of rounding.
    least = max(s.min_child_weight, 1e-9)
    gain[(hl < least) | (ha - hl < least)] = -np.inf
    gain = gain.reshape(len(g), -1)
    # The first of all splits that are best up to rounding: other orders of summing choose the same.
    most = gain.max(axis=1, keepdims=True)
    at = (gain >= most - np.abs(np.where(np.isfinite(most), most, 0)) * EQUAL).argmax(axis=1)
    return gain[np.arange(len(g)), at], *np.divmod(at, g.shape[2])


def split_gains(sums: DataFrame, settings: Sequence[TreeSettings]) -> DataFrame:
    """Every split of every node with its gain and both sides' sums.

    ``sums``: model, node, feature, bin, g, h, n (rows). Parameters are those of the model.
    """
    of = lambda name: F.element_at(F.array(*[F.lit(float(getattr(s, name))) for s in settings]), F.col("model") + 1)
    along = Window.partitionBy("model", "node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("model", "node", "feature")
    sides = sums.select(
        "model", "node", "feature", "bin",
        *[F.sum(c).over(along).alias(f"{c}l") for c in ("g", "h", "n")],
        *[F.sum(c).over(whole).alias(f"{c}a") for c in ("g", "h", "n")],
    ).withColumns({f"{c}r": F.col(f"{c}a") - F.col(f"{c}l") for c in ("g", "h", "n")})

    def part(g: str, h: str) -> Column:
        low = F.greatest(F.abs(g) - of("alpha"), F.lit(0.0))
        return low * low / (F.col(h) + of("l2"))

    gain = (part("gl", "hl") + part("gr", "hr") - part("ga", "ha")) / 2 - of("gamma")
    least = F.greatest(of("min_child_weight"), F.lit(1e-9))
    return sides.withColumn("gain", gain).withColumn("allowed", (F.col("hl") >= least) & (F.col("hr") >= least))


def first_level(rows: DataFrame, target: str, features: Sequence[str], settings: TreeSettings, weight: str | None = None, bins: int = BINS) -> DataFrame:
    """feature, threshold, gain, left_value, right_value: what the first tree's root can choose from."""
    cuts = column_cuts(rows, features, bins)
    heavy = F.col(weight).cast("double") if weight else F.lit(1.0)
    base = F.sum(F.col(target) * heavy) / F.sum(heavy)
    mean = rows.filter(F.col(target).isNotNull()).agg(base.alias("b")).first()["b"]

    def cell(i: int) -> Column:
        x = F.nanvl(F.col(features[i]).cast("double"), F.lit(None).cast("double"))
        below = F.filter(F.array(*[F.lit(float(c)) for c in cuts[i]]), lambda c: c < x)
        return F.struct(F.lit(i).alias("feature"), F.array_size(below).alias("bin"))

    cells = F.array(*[cell(i) for i in range(len(features))])
    sums = rows.filter(F.col(target).isNotNull()).select(((F.lit(mean) - F.col(target)) * heavy).alias("g"), heavy.alias("h"), F.explode(cells).alias("c"))
    sums = sums.groupBy("c.feature", "c.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
    gains = split_gains(sums.withColumns({"model": F.lit(0), "node": F.lit(1)}), [settings]).filter("allowed")
    value = lambda g, h: -F.signum(g) * F.greatest(F.abs(g) - settings.alpha, F.lit(0.0)) / (F.col(h) + settings.l2) * settings.eta
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1)
    at = F.element_at(F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in cuts]), F.col("feature") + 1), F.col("bin") + 1)
    return gains.select(names.alias("feature"), at.alias("threshold"), "gain", value("gl", "hl").alias("left_value"), value("gr", "hr").alias("right_value"))


# ------------------------------------------------------------ growing


@dataclass
class Round:
    """What a task needs to know of the models: settings, the trees being grown, columns drawn."""

    number: int
    seed: int
    settings: list[TreeSettings]
    trees: list[Tree]
    columns: list[np.ndarray]
    n_bins: int
    kind: str
    open: dict = field(default_factory=dict)

    def drawn(self, u: np.ndarray, share: float) -> np.ndarray:
        """Places of the rows drawn."""
        if share >= 1:
            return np.arange(len(u))
        x = u.astype(np.uint64) ^ np.uint64((self.number * 0x9E3779B97F4A7C15 + self.seed * 0xC2B2AE3D27D4EB4F) % (1 << 64))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return np.nonzero((x >> np.uint64(44)).astype(float) < share * SPAN)[0]

    def gradients(self, block: tuple, models: Sequence[int]) -> Iterator[tuple]:
        """Per model: its number, bins, gradient, Hessian and hash of the rows drawn for it."""
        bins, y, w, u, margins = block
        kept: dict[float, tuple] = {}
        for t in models:
            share = self.settings[t].subsample
            if share not in kept:
                at = self.drawn(u, share)
                kept[share] = at, bins.take(at, axis=1), y.take(at), w.take(at), u.take(at)
            at, own, target, h, mixed = kept[share]
            yield t, own, h * (margins[t].take(at) - target), h, mixed

    def slots(self, nodes: dict[int, list[int]]) -> dict[int, Tree]:
        """Per model a tree that answers the place of a row's node among those given, else -1."""
        out = {}
        for t, own in nodes.items():
            place = np.full(len(self.trees[t].feature), -1, np.int16 if len(own) < 1 << 15 else np.int32)
            place[own] = np.arange(len(own))
            out[t] = Tree(self.trees[t].feature, self.trees[t].cut, place).whole()
        return out

    def sums(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray, slot: np.ndarray, n: int, t: int) -> np.ndarray:
        """(3, n, columns drawn, bins): sums of gradient, Hessian and rows per slot."""
        out, size, first = np.zeros((3, n, len(self.columns[t]), self.n_bins)), n * self.n_bins, slot.astype(np.int64) * self.n_bins
        alike = len(h) > 0 and bool((h == h[0]).all())
        for k, column in enumerate(self.columns[t]):
            cell = first + bins[column]
            rows = np.bincount(cell, minlength=size)
            for j, x in enumerate((np.bincount(cell, g, size), h[0] * rows if alike else np.bincount(cell, h, size), rows)):
                out[j, :, k] = x.reshape(n, self.n_bins)
        return out


PACKED = "model int, node int, found binary"


def packed_rows(model: int, nodes: Sequence[int], found: Sequence[np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array([model] * len(nodes), pa.int32()), pa.array(nodes, pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["model", "node", "found"])


def grow_level(state: DataFrame, now: Round) -> dict:
    """The best split of each open node: (model, node) to a row with its sums; nodes without rows are missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {t: np.zeros((3, len(nodes), len(now.columns[t]), now.n_bins)) for t, nodes in now.open.items()}
        slots = now.slots(now.open)
        for block in blocks(batches, now.kind):
            for t, bins, g, h, _ in now.gradients(block, list(now.open)):
                slot = slots[t].answers(bins)
                keep = slot >= 0
                if not keep.all():
                    bins, g, h, slot = bins[:, keep], g[keep], h[keep], slot[keep]
                totals[t] += now.sums(bins, g, h, slot, len(now.open[t]), t)
        for t, nodes in now.open.items():
            found = [i for i in range(len(nodes)) if totals[t][2, i].any()]
            yield packed_rows(t, [nodes[i] for i in found], [totals[t][:, i] for i in found])

    def best(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        t, node = int(key[0]), int(key[1])
        total = sum(np.frombuffer(x).reshape(3, -1, now.n_bins) for x in parts["found"])
        gain, feature, cut = (x[0] for x in best_splits(total[:1], total[1:2], now.settings[t]))
        whole, left = total[:, feature].sum(axis=1), total[:, feature, : cut + 1].sum(axis=1)
        sides = {f"{c}{side}": x[j] for side, x in (("l", left), ("r", whole - left), ("a", whole)) for j, c in enumerate("ghn")}
        return pd.DataFrame([{"model": t, "node": node, "gain": gain, "feature": now.columns[t][feature], "bin": cut, **sides}])

    schema = "model int, node int, gain double, feature int, bin int, " + ", ".join(f"{c}{side} double" for side in "lra" for c in "ghn")
    found = read_for(state, list(now.open)).mapInArrow(run, PACKED).groupBy("model", "node").applyInPandas(best, schema).collect()
    return {(r["model"], r["node"]): r for r in found}


def subtree(now: Round, t: int, node: int, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """node, feature, cut, value of a node and all below it, one level at a time."""
    s, columns, found = now.settings[t], now.columns[t], []
    nodes, slot = np.array([node]), np.zeros(len(g), np.int64)
    while len(nodes):
        total = now.sums(bins, g, h, slot, len(nodes), t)
        leaves = -s.eta * shrunk(total[0, :, 0].sum(axis=1), s.alpha) / (total[1, :, 0].sum(axis=1) + s.l2)
        gain, feature, cut = best_splits(total[0], total[1], s)
        split = (gain > 0) & (nodes < 1 << s.max_depth)
        found.append(np.stack([nodes, np.where(split, columns[feature], -1), cut, np.where(split, 0.0, leaves)], axis=1))
        # Rows of split nodes go on; children take slots in the order of their parents.
        first = 2 * (np.cumsum(split) - 1)
        keep = split[slot]
        if not keep.all():
            bins, g, h, slot = bins[:, keep], g[keep], h[keep], slot[keep]
        slot = first[slot] + (bins[columns[feature[slot]], np.arange(len(slot))] > cut[slot])
        nodes = np.stack([2 * nodes[split], 2 * nodes[split] + 1], axis=1).ravel()
    return np.concatenate(found)


def finish_nodes(state: DataFrame, now: Round, small: dict[int, list[int]], n_features: int) -> pd.DataFrame:
    """Subtrees of the small open nodes, each grown by the task that receives the node's rows."""
    row = np.dtype([("u", "<i8"), ("g", "<f8"), ("h", "<f8"), ("bins", now.kind, (n_features,))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = now.slots(small)
        for block in blocks(batches, now.kind):
            for t, bins, g, h, u in now.gradients(block, sorted(small)):
                slot = slots[t].answers(bins)
                order = np.argsort(slot, kind="stable")
                ends = np.searchsorted(slot[order], np.arange(len(small[t]) + 1))
                order, ends = order[ends[0] :], ends - ends[0]
                rows = np.empty(len(order), row)
                for c, x in (("u", u), ("g", g), ("h", h)):
                    rows[c] = x.take(order)
                rows["bins"] = bins.take(order, axis=1).T
                parts = [(small[t][i], rows[lo:hi]) for i, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])) if lo < hi]
                yield packed_rows(t, [node for node, _ in parts], [x for _, x in parts])

    def grow(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        t, node = int(key[0]), int(key[1])
        rows = np.frombuffer(b"".join(parts["found"]), row)
        # In the order of their content, so that sums of floats do not follow the partitioning.
        rows = rows[np.argsort(rows["u"], kind="stable")]
        found = subtree(now, t, node, *[np.ascontiguousarray(rows[c].T) for c in ("bins", "g", "h")])
        return pd.DataFrame({"model": t, "node": found[:, 0], "feature": found[:, 1], "cut": found[:, 2], "value": found[:, 3]})

    grown = read_for(state, sorted(small)).mapInArrow(run, PACKED).groupBy("model", "node").applyInPandas(grow, "model int, node int, feature int, cut int, value double")
    return grown.toArrow().to_pandas()


def grow_trees(state: DataFrame, now: Round, n_rows: int, n_features: int) -> None:
    """Fills ``now.trees``: large nodes level by level, small ones in one task each."""
    waiting = {(t, 1): n_rows * min(s.subsample, 1.0) for t, s in enumerate(now.settings)}
    small: dict[int, list[int]] = {}
    while waiting:
        now.open = {}
        for (t, node), n in waiting.items():
            (small if n <= NODE_ROWS else now.open).setdefault(t, []).append(node)
        waiting = {}
        if not now.open:
            break
        found = grow_level(state, now)
        for t, nodes in now.open.items():
            s, tree = now.settings[t], now.trees[t]
            for node in nodes:
                r = found.get((t, node))
                if r is None or r["gain"] <= 0:
                    tree.value[node] = leaf_value(r["ga"], r["ha"], s) if r else 0.0
                    continue
                tree.feature[node], tree.cut[node] = r["feature"], r["bin"]
                for child, side in ((2 * node, "l"), (2 * node + 1, "r")):
                    if child.bit_length() > s.max_depth:
                        tree.value[child] = leaf_value(r[f"g{side}"], r[f"h{side}"], s)
                    else:
                        waiting[t, child] = r[f"n{side}"]
    if small:
        for t, own in finish_nodes(state, now, small, n_features).groupby("model"):
            tree, at = now.trees[t], own["node"].to_numpy()
            tree.feature[at], tree.cut[at], tree.value[at] = own["feature"], own["cut"], own["value"]


def with_margins(state: DataFrame, trees: list[Tree], kind: str) -> DataFrame:
    """The state with a round's trees added to the margins."""
    whole = [tree.whole() for tree in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [[] for _ in whole]
            for bins, *_, own in blocks([batch], kind):
                for t, tree in enumerate(whole):
                    margins[t].append((own[t] + tree.answers(bins)).tobytes())
            columns = batch.columns[: -len(whole)] + [pa.array(m, pa.binary()) for m in margins]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return state.mapInArrow(run, state.schema)


# ------------------------------------------------------------ rows held by tasks


@dataclass
class Held:
    """Rows of a task in parts of ``PART``: bins (features x rows), target, weights and hash; ``alike`` is the weight of all, if there is one."""

    parts: list[tuple]
    alike: float | None
    drawn: dict = field(default_factory=dict)

    def draw(self, now: Round, share: float) -> list:
        """Places of the rows drawn in a round, per part."""
        if self.drawn.get("number") != now.number:
            self.drawn = {"number": now.number}
        if share not in self.drawn:
            self.drawn[share] = [now.drawn(u, share) if share < 1 else slice(None) for *_, u in self.parts]
        return self.drawn[share]

    @classmethod
    def of(cls, rows: Iterator[tuple], alike: float | None) -> Held:
        own = [(bins, y, w if alike is None else None, u) for bins, y, w, u, _ in rows]
        if not own:
            return cls([], alike)
        bins, y, w, u = (None if x[0] is None else np.concatenate(x, axis=-1) for x in zip(*own))
        del own
        # In the order of their content, so that sums of floats do not follow the order of arrival.
        order = np.argsort(u, kind="stable")
        places = [order[low : low + PART] for low in range(0, len(u), PART)]
        return cls([(bins.take(at, axis=1), y.take(at), None if w is None else w.take(at), u.take(at)) for at in places], alike)


class HeldModel:
    """One model's margins on the held rows and the tree that it grows: ``count`` and ``split`` in turns, level by level."""

    def __init__(self, held: Held, settings: TreeSettings, base: float):
        self.held, self.s = held, settings
        self.margins = [np.full(len(y), base) for _, y, _, _ in held.parts]

    def start(self, now: Round, columns: np.ndarray) -> None:
        self.now, self.columns, self.tree = now, columns, Tree.empty(self.s.max_depth)
        self.counted, self.above, self.split_any = [1], None, False
        self.at, self.g, self.h, self.drawn = [], [], [], self.held.draw(now, self.s.subsample)
        for (_, y, w, _), margin, own in zip(self.held.parts, self.margins, self.drawn):
            h = self.held.alike if w is None else w[own]
            self.at.append(np.ones(len(y), np.int64))
            self.g.append(h * (margin[own] - y[own]))
            self.h.append(h)

    def _route(self) -> None:
        """Rows go one level down; those of an earlier leaf to the left."""
        kind = np.dtype(self.now.kind)
        inner = self.tree.feature >= 0
        cut = np.where(inner, self.tree.cut, np.iinfo(kind).max).astype(kind)
        feature = np.where(inner, self.tree.feature, 0).astype(np.int64)
        for i, (bins, *_) in enumerate(self.held.parts):
            at, n = self.at[i], bins.shape[1]
            place = (feature * n).take(at)
            place += np.arange(n)
            right = bins.ravel().take(place) > cut.take(at)
            at += at
            at += right

    def count(self) -> np.ndarray:
        """Sums of gradient, rows and, unless all weigh alike, Hessian of the counted nodes ((2 or 3) x nodes x columns x bins)."""
        if self.split_any:
            self._route()
        n, n_bins = len(self.counted), self.now.n_bins
        size, weighted = n * n_bins, self.held.alike is None
        out = np.zeros((2 + weighted, n, len(self.columns), n_bins))
        table = np.full(len(self.tree.feature), -1)
        table[self.counted] = np.arange(n) * n_bins
        for (bins, *_), at, own, g, h in zip(self.held.parts, self.at, self.drawn, self.g, self.h):
            first = table.take(at[own])
            if self.counted != [1]:
                kept = np.flatnonzero(first >= 0)
                own = kept if isinstance(own, slice) else own.take(kept)
                first, g, h = first.take(kept), g.take(kept), h.take(kept) if weighted else h
            for k, column in enumerate(self.columns):
                cell = first + bins[column][own]
                sums = [np.bincount(cell, g, size), np.bincount(cell, minlength=size)]
                for j, x in enumerate(sums + ([np.bincount(cell, h, size)] if weighted else [])):
                    out[j, :, k] += x.reshape(n, n_bins)
        return out

    def split(self, total: np.ndarray) -> None:
        """Splits the open nodes, whose counted ones have these sums over all tasks; ``counted`` are then the smaller children."""
        s, tree, nodes = self.s, self.tree, np.array(self.counted)
        if self.above is not None:
            total = np.stack([total, self.above - total], axis=2).reshape(len(total), -1, *total.shape[2:])
            nodes = np.stack([nodes, nodes ^ 1], axis=1).ravel()
        g, n = np.where(total[1] > 0, total[0], 0.0), total[1]
        h = n * self.held.alike if len(total) == 2 else np.where(n > 0, total[2], 0.0)
        gain, feature, cut = best_splits(g, h, s)
        tree.value[nodes] = -s.eta * shrunk(g[:, 0].sum(axis=1), s.alpha) / np.where(n[:, 0].any(axis=1), h[:, 0].sum(axis=1) + s.l2, 1.0)
        at = np.flatnonzero((gain > 0) & (nodes < 1 << s.max_depth))
        tree.feature[nodes[at]], tree.cut[nodes[at]], tree.value[nodes[at]] = self.columns[feature[at]], cut[at], 0.0
        left = np.stack([x[at, feature[at]].cumsum(axis=1)[np.arange(len(at)), cut[at]] for x in (g, h, n)])
        whole = np.stack([x[at, feature[at]].sum(axis=1) for x in (g, h, n)])
        self.split_any, self.above, self.counted = len(at) > 0, total[:, at], []
        if not len(at):
            return
        if int(nodes[0]).bit_length() >= s.max_depth:
            for side, (own_g, own_h, _) in enumerate((left, whole - left)):
                tree.value[2 * nodes[at] + side] = -s.eta * shrunk(own_g, s.alpha) / (own_h + s.l2)
        else:
            self.counted = (2 * nodes[at] + (2 * left[2] > whole[2])).tolist()

    def finish(self) -> Tree:
        """The grown tree, which is added to the margins."""
        if self.split_any:
            self._route()
        value = self.tree.whole().value
        for margin, at in zip(self.margins, self.at):
            margin += value.take(at)
        return self.tree


class Told:
    """Sums that the tasks of a barrier stage tell each other by files in the shared folder: a task writes its own and reads all.

    Spark's own gathering waits a second each time. A task has read all files of one step when it writes those of the next, so
    files two steps old are no longer wanted.
    """

    def __init__(self, folder: str):
        at = BarrierTaskContext.get()
        self.own, self.n, self.step = at.partitionId(), len(at.getTaskInfos()), 0
        self.folder = f"{folder}/{at.allGather(uuid.uuid4().hex)[0]}"  # one per attempt of the stage
        os.makedirs(self.folder, exist_ok=True)

    def _path(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def sums(self, parts: list[np.ndarray], cells: list[np.ndarray]) -> list[np.ndarray]:
        """The sums of all tasks, added up in the order of the tasks; ``cells`` are the (column, bin) that exist."""
        own = [x[..., at] for x, at in zip(parts, cells)]
        path = self._path(self.step, self.own)
        np.concatenate([x.ravel() for x in own]).tofile(f"{path}.part")
        os.rename(f"{path}.part", path)
        total = 0.0
        for task in range(self.n):
            while not os.path.exists(self._path(self.step, task)):
                time.sleep(0.0005)
            total = total + np.fromfile(self._path(self.step, task))
        if self.step > 1:
            os.remove(self._path(self.step - 2, self.own))
        self.step += 1
        out, low = [], 0
        for x, at, part in zip(own, cells, parts):
            whole = np.zeros(part.shape)
            whole[..., at] = total[low : low + x.size].reshape(x.shape)
            out.append(whole)
            low += x.size
        return out


TREES = "model int, number int, feature binary, cut binary, value binary"


def grow_held(held: Held, models: dict[int, TreeSettings], rounds: int, seed: int, base: float, sizes: list[int], kind: str, told: Told | None) -> Iterator[tuple]:
    """(model, number, tree) of all rounds; ``sizes`` are the numbers of bins per feature."""
    own = {t: HeldModel(held, s, base) for t, s in models.items()}
    n_bins = max(sizes)
    exists = np.arange(n_bins) < np.array(sizes)[:, None]
    for number in range(rounds):
        now = Round(number, seed, [], [], [], n_bins, kind)
        for m in own.values():
            m.start(now, drawn_columns(seed, number, len(sizes), m.s))
        while growing := [m for m in own.values() if m.counted]:
            sums = [m.count() for m in growing]
            for m, total in zip(growing, told.sums(sums, [exists[m.columns] for m in growing]) if told else sums):
                m.split(total)
        for t, m in own.items():
            yield t, number, m.finish()


def task_slots(spark: SparkSession) -> int:
    """How many tasks of a barrier stage can share a folder; 0 if the number of cores may change or files cannot be shared."""
    sc, root = spark.sparkContext, checkpoint_root(spark)
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    if sc._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(sc._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return 0
    return sc._jsc.sc().maxNumConcurrentTasks(sc._jsc.sc().resourceProfileManager().defaultResourceProfile())


def held_tasks(spark: SparkSession, settings: Sequence[TreeSettings], n_rows: int, sizes: list[int]) -> tuple[int, bool] | None:
    """How many tasks hold the rows, and whether they share them; None if they do not fit."""
    most = lambda models: HELD_BYTES // (40 + 4 * len(sizes) + 32 * models)
    if n_rows <= FEW_ROWS:
        return len(settings), False
    slots = task_slots(spark)
    told = sum(sum(sizes) * 24 << max(s.max_depth - 1, 0) for s in settings) * slots
    if slots > 1 and told <= TOLD and n_rows <= slots * most(len(settings)):
        return slots, True
    return (len(settings), False) if n_rows <= most(1) else None


def fit_held(state: DataFrame, settings: Sequence[TreeSettings], rounds: int, seed: int, base: float, alike: float | None, sizes: list[int], kind: str, tasks: int, together: bool) -> list[list[Tree]]:
    """The trees of each model, grown in one stage by tasks that hold the rows of the blocks of ``state``."""
    folder = scratch_path(state.sparkSession, "told").removeprefix("file:") if together else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None and not together:
            return
        # Without a block, a task that shares the rows still takes part.
        read = itertools.chain([] if first is None else [first], batches)
        models = dict(enumerate(settings)) if together else {(t := first.column("task")[0].as_py()): settings[t]}
        held = Held.of(blocks((b.select(["bins", "y", "w", "u"]) for b in read), kind), alike)
        told = Told(folder) if together else None
        for t, number, tree in grow_held(held, models, rounds, seed, base, sizes, kind, told):
            if told is None or told.own == 0:
                columns = [pa.array([t], pa.int32()), pa.array([number], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (tree.feature, tree.cut, tree.value)]]
                yield pa.RecordBatch.from_arrays(columns, ["model", "number", "feature", "cut", "value"])

    # Blocks of one partition go to different tasks; without sharing, each task gets all of them.
    place = (F.spark_partition_id() + F.monotonically_increasing_id() % (1 << 33)) % tasks
    task = place.cast("int") if together else F.explode(F.array(*[F.lit(t) for t in range(len(settings))]))
    given = state.select("bins", "y", "w", "u", task.alias("task")).repartitionById(tasks, "task")
    grown = given.mapInArrow(run, TREES, barrier=together).toArrow().to_pydict()
    out = [[None] * rounds for _ in settings]
    for t, number, *tree in zip(*[grown[c] for c in ("model", "number", "feature", "cut", "value")]):
        out[t][number] = Tree(*[np.frombuffer(x, k).copy() for x, k in zip(tree, (np.int32, np.int32, float))])
    return out


@dataclass
class BoostedTrees:
    """A fitted model: sums one value per tree, beginning with ``base``."""

    features: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree]

    def transform(self, df: DataFrame) -> DataFrame:
        """Input columns plus ``prediction``; missing features lie below every value."""
        cuts, trees, base = self.cuts, [tree.whole() for tree in self.trees], self.base

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            values = [np.nan_to_num(c.to_numpy(float, na_value=np.nan), nan=-np.inf, posinf=np.inf, neginf=-np.inf) for c in columns]
            bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, values)])
            out = np.full(bins.shape[1], base)
            for tree in trees:
                out += tree.answers(bins)
            return pd.Series(out)

        return df.withColumn("prediction", predict(*[F.col(c).cast("double") for c in self.features]))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """tree, node, feature, threshold, value: one row per node that can be reached."""
        rows = []
        for k, tree in enumerate(self.trees):
            reached = [1]
            for node in reached:
                f = int(tree.feature[node])
                if f >= 0:
                    reached += [2 * node, 2 * node + 1]
                rows.append((k, node, self.features[f] if f >= 0 else None, float(self.cuts[f][tree.cut[node]]) if f >= 0 else None, float(tree.value[node])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, value double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and columns as tables; an earlier model at the path is replaced."""
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        columns = [(i, f, [float(x) for x in c], self.base, len(self.trees)) for i, (f, c) in enumerate(zip(self.features, self.cuts))]
        spark.createDataFrame(columns, "i int, feature string, cuts array<double>, base double, n_trees int").write.mode("overwrite").parquet(f"{path}/columns")


def load_boosted(spark: SparkSession, path: str) -> BoostedTrees:
    columns = spark.read.parquet(f"{path}/columns").orderBy("i").collect()
    features, cuts = [r["feature"] for r in columns], [list(r["cuts"]) for r in columns]
    rows = spark.read.parquet(f"{path}/nodes").toPandas()
    trees = []
    for _, own in rows.groupby("tree"):
        tree = Tree.empty(int(own["node"].max()).bit_length() - 1)
        for node, f, x, value in zip(own["node"], own["feature"], own["threshold"], own["value"]):
            tree.value[node] = value
            if f is not None:
                k = features.index(f)
                tree.feature[node], tree.cut[node] = k, cuts[k].index(x)
        trees.append(tree)
    return BoostedTrees(features, cuts, columns[0]["base"], trees)


def drawn_columns(seed: int, number: int, n: int, s: TreeSettings) -> np.ndarray:
    """The columns of a round's tree: one order per round, so a model does not depend on those grown beside it."""
    order = np.random.default_rng([seed, number]).permutation(n)
    return np.sort(order[: max(1, round(s.colsample * n))])


def fit_boosted(
    rows: DataFrame,
    target: str,
    features: Sequence[str],
    settings: Sequence[TreeSettings],
    rounds: int,
    weight: str | None = None,
    seed: int = 1729,
    bins: int = BINS,
) -> list[BoostedTrees]:
    """One model per entry of ``settings``, all grown in the same passes over the rows."""
    features, settings = list(features), list(settings)
    heavy = F.col(weight).cast("double") if weight else F.lit(1.0)
    y = F.col(target).cast("double")
    usable = rows.filter(y.isNotNull() & ~F.isnan(y) & (heavy > 0))
    known = usable.agg(
        (F.sum(y * heavy) / F.sum(heavy)).alias("base"), F.count(F.lit(1)).alias("n"), F.min(heavy).alias("least"), F.max(heavy).alias("most")
    ).first()
    if not known["n"]:
        raise ValueError("no row to learn from")
    cuts = column_cuts(usable, features, bins)
    cuts = [c or [-np.inf] for c in cuts]
    models, sizes = [BoostedTrees(features, cuts, known["base"], []) for _ in settings], [len(c) + 1 for c in cuts]
    tasks = held_tasks(rows.sparkSession, settings, known["n"], sizes) if rounds >= HELD_ROUNDS else None
    if tasks:
        state = binned(usable, target, features, cuts, weight, [], known["n"])
        alike = known["least"] if known["least"] == known["most"] else None
        for model, trees in zip(models, fit_held(state, settings, rounds, seed, known["base"], alike, sizes, bin_type(cuts), *tasks)):
            model.trees = trees
        return models
    state = earlier = binned(usable, target, features, cuts, weight, [known["base"]] * len(settings), known["n"])
    for number in range(rounds):
        columns = [drawn_columns(seed, number, len(features), s) for s in settings]
        trees = [Tree.empty(s.max_depth) for s in settings]
        now = Round(number, seed, settings, trees, columns, max(sizes), bin_type(cuts))
        grow_trees(state, now, known["n"], len(features))
        earlier.unpersist()
        for model, tree in zip(models, trees):
            model.trees.append(tree)
        if number + 1 < rounds:
            earlier, state = state, with_margins(state, trees, now.kind)
            state = state.persist() if (number + 1) % KEPT_TREES else materialize(state)
    state.unpersist()
    return models


def settings_of(values: dict, **fixed) -> TreeSettings:
    """Settings from drawn values (whole depths) and fixed ones."""
    known = {**asdict(TreeSettings()), **fixed, **values}
    return TreeSettings(**{**known, "max_depth": int(round(known["max_depth"]))})
