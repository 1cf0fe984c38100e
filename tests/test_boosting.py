"""Trees of second order and the Bayesian search."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bindings.models import FEATURES, TARGET, lines
from stockweave.operators import bayes, boosting, tabular
from stockweave.operators.boosting import Tree, TreeSettings, best_splits, column_cuts, fit_boosted, load_boosted
from stockweave.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("w", F.lit(8.0)).cache()


def rmse(model, df):
    return model.transform(df).agg(F.sqrt(F.avg((F.col("prediction") - F.col(TARGET)) ** 2))).first()[0]


def same(a, b):
    assert len(a.trees) == len(b.trees)
    for x, y in zip(a.trees, b.trees):
        assert np.array_equal(x.feature, y.feature) and np.allclose(x.value, y.value)


SOME = [
    TreeSettings(max_depth=4, gamma=1.7, alpha=0.1, subsample=0.61, colsample=0.6),
    TreeSettings(eta=0.5, max_depth=5, min_child_weight=400.0),
]


def test_large_nodes_grow_the_same_trees_level_by_level(spark, rows, monkeypatch):
    train = rows.filter("split = 'train'")
    whole = fit_boosted(train, TARGET, FEATURES, SOME, 3, "w")
    monkeypatch.setattr(boosting, "NODE_ROWS", 0)
    for a, b in zip(whole, fit_boosted(train.repartition(5), TARGET, FEATURES, SOME, 3, "w")):
        same(a, b)
    monkeypatch.setattr(boosting, "NODE_ROWS", 700)
    for a, b in zip(whole, fit_boosted(train, TARGET, FEATURES, SOME, 3, "w")):
        same(a, b)


def test_a_model_does_not_depend_on_those_beside_it(rows, monkeypatch):
    train = rows.filter("split = 'train'")
    monkeypatch.setattr(boosting, "KEPT_TREES", 2)  # margins are written in between
    both = fit_boosted(train, TARGET, FEATURES, SOME, 5, "w")
    same(both[0], fit_boosted(train, TARGET, FEATURES, SOME[:1], 5, "w")[0])
    same(both[1], fit_boosted(train, TARGET, FEATURES, SOME[1:], 5, "w")[0])


def plain_tree(x, y, w, margin, s):
    """Exhaustive search over all values, row by row."""
    tree = {}

    def value(g, h):
        return -s.eta * math.copysign(max(abs(g) - s.alpha, 0), g) / (h + s.l2)

    def part(g, h):
        return max(abs(g) - s.alpha, 0) ** 2 / (h + s.l2)

    def grow(node, keep):
        g, h = w[keep] * (margin[keep] - y[keep]), w[keep]
        best = (0.0, None, None)
        if node.bit_length() <= s.max_depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[keep, f])[:-1]:
                    left = x[keep, f] <= cut
                    hl, hr = h[left].sum(), h[~left].sum()
                    if min(hl, hr) >= s.min_child_weight:
                        gain = (part(g[left].sum(), hl) + part(g[~left].sum(), hr) - part(g.sum(), h.sum())) / 2 - s.gamma
                        if gain > best[0] + 1e-9:
                            best = (gain, f, cut)
        if best[1] is None:
            tree[node] = value(g.sum(), h.sum())
            return
        left = x[keep, best[1]] <= best[2]
        tree[node] = best[1:]
        grow(2 * node, keep[left])
        grow(2 * node + 1, keep[~left])

    grow(1, np.arange(len(y)))
    return tree


@pytest.mark.parametrize("limit", [0, 10_000])
def test_trees_equal_an_exhaustive_search(spark, monkeypatch, limit):
    monkeypatch.setattr(boosting, "NODE_ROWS", limit)
    draw = np.random.default_rng(4)
    data = pd.DataFrame({"a": draw.integers(0, 9, 300).astype(float), "b": draw.integers(0, 5, 300).astype(float), "w": draw.integers(1, 4, 300).astype(float)})
    data["y"] = data["a"] * 3 + (data["b"] > 2) * 7 + draw.normal(0, 1, 300)
    s = TreeSettings(eta=0.5, max_depth=3, min_child_weight=6.0, gamma=2.0, alpha=1.5)
    model = fit_boosted(spark.createDataFrame(data), "y", ["a", "b"], [s], 2, "w")[0]
    x, y, w = data[["a", "b"]].to_numpy(), data["y"].to_numpy(), data["w"].to_numpy()
    margin = np.full(300, (w * y).sum() / w.sum())
    for tree in model.trees:
        want = plain_tree(x, y, w, margin, s)
        for node, found in want.items():
            if isinstance(found, tuple):
                assert (tree.feature[node], model.cuts[tree.feature[node]][tree.cut[node]]) == found
            else:
                assert tree.feature[node] == -1 and tree.value[node] == pytest.approx(found)
        for i in range(300):
            node = 1
            while isinstance(want[node], tuple):
                node = 2 * node + int(x[i, want[node][0]] > want[node][1])
            margin[i] += want[node]
    got = model.transform(spark.createDataFrame(data)).toPandas()["prediction"]
    assert np.allclose(np.sort(got), np.sort(margin))


def test_fitted_error_beats_group_means(rows):
    known = rows.withColumn(TARGET, F.col("l_quantity") * F.col("p_size") * (1 - F.col("l_discount")))
    train, test = known.filter("split = 'train'"), known.filter("split = 'test'")
    model = fit_boosted(train, TARGET, FEATURES, [TreeSettings(max_depth=4)], 20, "w")[0]
    for group in ("l_quantity", "p_size"):
        means = train.groupBy(group).agg(F.avg(TARGET).alias("prediction"))
        by_group = test.join(means, group).agg(F.sqrt(F.avg((F.col("prediction") - F.col(TARGET)) ** 2))).first()[0]
        assert rmse(model, test) < 0.2 * by_group


def test_penalties_prune(rows):
    train = rows.filter("split = 'train'")
    none = [TreeSettings(gamma=1e18), TreeSettings(alpha=1e18), TreeSettings(min_child_weight=1e18)]
    free, *bound = fit_boosted(train, TARGET, FEATURES, [TreeSettings(), *none], 1, "w")
    assert (free.trees[0].feature >= 0).sum() > 10
    assert all((m.trees[0].feature < 0).all() for m in bound)
    assert bound[1].trees[0].value[1] == 0


def test_saved_models_answer_alike(spark, rows):
    model = fit_boosted(rows.filter("split = 'train'"), TARGET, FEATURES, [TreeSettings(max_depth=3)], 4)[0]
    path = scratch_path(spark, "boosted")
    for _ in range(2):  # a repeated save replaces the first
        model.save(spark, path)
    again = load_boosted(spark, path)
    test = rows.filter("split = 'test'")
    one, two = (m.transform(test).orderBy("l_orderkey", *FEATURES, TARGET).toPandas()["prediction"] for m in (model, again))
    assert len(one) == test.count() and np.array_equal(one, two)


def test_whole_trees_answer_alike():
    draw = np.random.default_rng(8)
    bins = draw.integers(0, 6, (3, 500)).astype("u1")
    for inner in ([], [1], [1, 3, 6, 13], [1, 2, 5]):
        tree = Tree.empty(4)
        tree.feature[inner], tree.cut[inner] = draw.integers(0, 3, len(inner)), draw.integers(1, 4, len(inner))
        tree.value[:] = draw.normal(size=len(tree.value))
        assert np.array_equal(tree.whole().answers(bins), tree.value[tree.nodes(bins)])


def test_a_round_reads_margins_of_all_earlier_trees_and_leaves_nothing_cached(spark, rows, monkeypatch):
    train, persisted, seen = rows.filter("split = 'train'"), spark.sparkContext._jsc.getPersistentRDDs, []
    before = persisted().size()
    plain = boosting.grow_trees

    def watched(state, *more):
        u, m = (np.concatenate([np.frombuffer(r[c], kind) for r in state.select("u", "m0").collect()]) for c, kind in (("u", "<i8"), ("m0", "<f8")))
        seen.append(pd.Series(m, u).groupby(level=0).first())
        plain(state, *more)

    monkeypatch.setattr(boosting, "grow_trees", watched)
    monkeypatch.setattr(boosting, "KEPT_TREES", 2)
    model = fit_boosted(train, TARGET, FEATURES, [TreeSettings(max_depth=3)], 4, "w")[0]
    assert len(seen) == 4 and (seen[0] == model.base).all()
    for earlier, later, tree in zip(seen, seen[1:], model.trees):
        added = (later - earlier).to_numpy()
        assert added.any() and np.abs(added[:, None] - tree.value[None]).min(axis=1).max() < 1e-6
    assert persisted().size() == before


def test_missing_values_and_unusable_rows(spark):
    data = [(None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (1.0, 5.0, 1.0), (2.0, 9.0, 1.0), (2.0, None, 1.0), (2.0, 99.0, None), (2.0, 99.0, 0.0), (1.0, float("nan"), 1.0)] * 20
    df = spark.createDataFrame(data, "x double, y double, w double").withColumn("_y", F.lit("other")).withColumn("b0", F.lit("other"))
    model = fit_boosted(df, "y", ["x"], [TreeSettings(eta=1.0, max_depth=3, l2=0.0, min_child_weight=0.0)], 1, "w")[0]
    got = {(None if r["x"] is None or r["x"] != r["x"] else r["x"]): r["prediction"] for r in model.transform(df).collect()}
    assert got == pytest.approx({None: 1.0, 1.0: 5.0, 2.0: 9.0})
    assert model.cuts[0][0] == -math.inf
    with pytest.raises(ValueError):
        fit_boosted(df.limit(0), "y", ["x"], [TreeSettings()], 1)


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("k"))
    wide, narrow = column_cuts(df, ["x", "k"])
    assert len(wide) == boosting.BINS - 1 and narrow == [0.0, 1.0, 2.0]
    assert max(abs(c - 100_000 * (i + 1) / boosting.BINS) for i, c in enumerate(wide)) < 50


def test_splits_of_several_nodes_at_once():
    g, h = np.zeros((2, 1, 3)), np.ones((2, 1, 3))
    g[0, 0] = [-3, 0, 3]
    gain, feature, cut = best_splits(g, h, TreeSettings())
    assert gain[0] > 0 and feature[0] == 0 and cut[0] in (0, 1) and gain[1] <= 0
    assert Tree.empty(0).nodes(np.zeros((1, 2), int)).tolist() == [1, 1]


# ------------------------------------------------------------ Spark's own trees


def test_alike_rows_are_combined_before_the_rounds(spark, monkeypatch):
    draw = np.random.default_rng(3)
    data = pd.DataFrame({"a": draw.integers(0, 4, 400).astype(float), "b": draw.integers(0, 3, 400).astype(float), "w": draw.integers(0, 4, 400).astype(float)})
    data["y"] = data["a"] * 5 + data["b"] ** 2 + draw.normal(0, 1, 400)
    df = spark.createDataFrame(data)
    given, plain = [], tabular.boosted_trees

    class Watched:
        def __init__(self, *of, **settings):
            self.trees = plain(*of, **settings)

        def fit(self, rows):
            given.append(rows.count())
            return self.trees.fit(rows)

    monkeypatch.setattr(tabular, "boosted_trees", Watched)
    same_rows = dict(rounds=4, max_depth=3, gamma=0.0)
    for more in ({}, {"weight": "w"}):
        got = tabular.fit_regressor(df, "y", ["a", "b"], subsample=1.0, **same_rows, **more)
        want = plain("y", ["a", "b"], subsample=1.0, **same_rows, **more).fit(df)
        one, two = (tabular.score(m, df).groupBy("a", "b").agg(F.first("prediction").alias("p")).orderBy("a", "b").toPandas()["p"] for m in (got, want))
        assert len(one) == 12 and np.allclose(one, two)
    tabular.fit_regressor(df, "y", ["a", "b"], subsample=0.9, **same_rows)
    tabular.fit_regressor(df, "y", ["a", "b"], subsample=1.0, min_child_weight=5.0, **same_rows)
    assert given == [12, 12, 400, 400]


@pytest.mark.parametrize("bad", [{"y": None}, {"y": float("nan")}, {"w": None}, {"w": -1.0}])
def test_combined_rows_still_reject_unusable_ones(spark, bad):
    rows = [{"a": 1.0, "y": 2.0, "w": 1.0}] * 3 + [{"a": 2.0, "y": 5.0, "w": 1.0}, {"a": 1.0, "y": 3.0, "w": 5.0, **bad}]
    df = spark.createDataFrame([(r["a"], r["y"], r["w"]) for r in rows], "a double, y double, w double")
    with pytest.raises(Exception):
        tabular.boosted_trees("y", ["a"], rounds=1, subsample=1.0, weight="w").fit(df)
    with pytest.raises(Exception):
        tabular.fit_regressor(df, "y", ["a"], rounds=1, subsample=1.0, weight="w")


# ------------------------------------------------------------ search

SPACE = {"x": (0.0, 1.0), "y": (-2.0, 2.0), "n": (1, 4)}


def valley(s):
    return (s["x"] - 0.3) ** 2 * 8 + (s["y"] - 1) ** 2 / 2 + abs(s["n"] - 3)


def test_search_beats_random_draws():
    better = 0
    for seed in range(10):
        found = min(e for _, e in bayes.bayesian_search(lambda b: [valley(s) for s in b], SPACE, 20, 4, seed))
        draw = random.Random(seed)
        at_random = min(valley({"x": draw.random(), "y": draw.uniform(-2, 2), "n": draw.randint(1, 4)}) for _ in range(20))
        better += found < at_random
    assert better >= 9


def test_search_is_repeatable_and_stays_in_range():
    runs = [bayes.bayesian_search(lambda b: [valley(s) for s in b], SPACE, 9, 3, 7) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 9
    for s, _ in runs[0]:
        assert all(lo <= s[k] <= hi for k, (lo, hi) in SPACE.items()) and isinstance(s["n"], int)
    assert {s["n"] for s, _ in bayes.bayesian_search(lambda b: [0.0] * len(b), SPACE, 40, 40, 1)} == {1, 2, 3, 4}


def test_search_survives_failed_trials_and_uses_known_ones():
    sizes = []

    def run(batch):
        sizes.append(len(batch))
        return [None if s["x"] > 0.5 else float("inf") if s["y"] > 1.9 else valley(s) for s in batch]

    found = bayes.bayesian_search(run, SPACE, 10, 4, 3)
    assert sizes == [4, 4, 2] and len(found) == 10
    known = [({"x": 0.3, "y": 1.0, "n": 3}, 0.0), ({"x": 0.9, "y": -2.0, "n": 1}, 8.0), ({"x": 0.1, "y": 0.0, "n": 4}, 2.0)]
    near = bayes.bayesian_search(run, SPACE, 4, 1, 3, known)
    assert len(near) == 4 and min(valley(s) for s, _ in near) < 0.5
    assert len(bayes.bayesian_search(lambda b: [None] * len(b), SPACE, 4, 2, 3)) == 4


def test_process_interpolates():
    x = bayes.halton(12, 2, 1)
    y = np.sin(4 * x[:, 0]) + x[:, 1]
    mean, deviation = bayes.Process(x, y).predict(x)
    assert np.allclose(mean, y, atol=0.05) and deviation.max() < 0.2
