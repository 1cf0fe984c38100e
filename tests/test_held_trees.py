"""Boosted trees whose rows the tasks of one stage hold."""

import numpy as np
import pandas as pd
import pytest

from stockweave.operators import boosting
from stockweave.operators.boosting import TreeSettings, fit_boosted

FEATURES = ["a", "b", "c"]
SOME = [
    TreeSettings(max_depth=5, gamma=1.7, alpha=0.1, subsample=0.61, colsample=0.7),
    TreeSettings(eta=0.5, max_depth=3, min_child_weight=20.0),
    TreeSettings(max_depth=0),
]
FORMS = {"passes": (10**9, 0), "alone": (1, 10**9), "together": (1, 0)}


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(6)
    data = pd.DataFrame({"a": draw.normal(size=3000), "b": draw.integers(0, 9, 3000).astype(float), "c": draw.integers(0, 3, 3000).astype(float)})
    data["y"] = data["a"] * 9 + data["b"] ** 2 + (data["c"] > 1) * 12 + draw.normal(0, 1, 3000)
    data["eight"], data["w"] = 8.0, draw.integers(1, 5, 3000) / 7
    data.loc[::17, "b"] = np.nan
    return spark.createDataFrame(data).repartition(5).cache()


def fitted(monkeypatch, form, *given):
    for name, value in zip(("HELD_ROUNDS", "FEW_ROWS"), FORMS[form]):
        monkeypatch.setattr(boosting, name, value)
    return fit_boosted(*given)


@pytest.mark.parametrize("weight", [None, "eight", "w"])
def test_held_rows_grow_the_trees_of_the_passes(rows, monkeypatch, weight):
    want = fitted(monkeypatch, "passes", rows, "y", FEATURES, SOME, 4, weight)
    for form in ("alone", "together"):
        got = fitted(monkeypatch, form, rows, "y", FEATURES, SOME, 4, weight)
        for a, b in zip(want, got):
            assert a.base == b.base and len(a.trees) == len(b.trees) == 4
            for x, y in zip(a.trees, b.trees):
                assert np.array_equal(x.feature, y.feature) and np.allclose(x.value, y.value)
                assert np.array_equal(x.cut[x.feature >= 0], y.cut[y.feature >= 0])
    assert max(int((x.feature >= 0).sum()) for x in want[0].trees) > 15


def test_many_rounds_do_not_read_the_rows_again(rows, monkeypatch):
    def read(*given):
        raise AssertionError("a round of its own passes")

    monkeypatch.setattr(boosting, "grow_trees", read)
    model = fit_boosted(rows, "y", FEATURES, SOME[:2], 30, "eight")[0]
    assert len(model.trees) == 30


def test_fewer_rows_than_tasks(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 9.0), (2.0, 9.0)], "x double, y double")
    s = TreeSettings(eta=1.0, max_depth=2, l2=0.0, min_child_weight=0.0)
    for form in FORMS:
        model = fitted(monkeypatch, form, df, "y", ["x"], [s], 2)[0]
        got = {r["x"]: r["prediction"] for r in model.transform(df).collect()}
        assert got == pytest.approx({1.0: 5.0, 2.0: 9.0})


def test_rows_that_do_not_fit_are_read_in_passes(spark, monkeypatch):
    sizes = [65] * 6
    assert boosting.held_tasks(spark, SOME, 1000, sizes) == (3, False)
    assert boosting.held_tasks(spark, SOME, 1_000_000, sizes) == (8, True)
    assert boosting.held_tasks(spark, SOME, 10**9, sizes) is None
    deep = [TreeSettings(max_depth=14)] * 5
    assert boosting.held_tasks(spark, deep, 1_000_000, sizes) == (5, False)
    assert boosting.held_tasks(spark, deep, 20_000_000, sizes) is None
    monkeypatch.setattr(boosting, "task_slots", lambda spark: 0)
    assert boosting.held_tasks(spark, SOME, 1_000_000, sizes) == (3, False)
