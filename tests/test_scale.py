"""Partitions of grids and running sums: what keeps a task's rows bounded as tables grow."""

import re

import pytest
from pyspark.sql import functions as F

from bindings.common import supply
from helpers import plan_of
from stockweave.operators.forecast import hold_out, item_levels
from stockweave.operators.series import long_enough, regularize, resample_with_related, to_bins


def _grids(spark, sf_dir):
    bins = to_bins(supply(spark, sf_dir), "item", "ts", {"units": "mean"})
    yield regularize(bins, "item", {"units": "linear"}, cut=hold_out(28))
    yield regularize(long_enough(bins, "item", 29), "item", {"units": "linear"}, by_key=True)
    yield resample_with_related(supply(spark, sf_dir), supply(spark, sf_dir), "item", "ts", "units", "units")


def test_bins_are_spread_by_item_before_they_are_widened(spark, sf_dir):
    for grid in _grids(spark, sf_dir):
        plan = plan_of(grid)
        # A number given by name is not merged by the small size of the observed bins.
        assert re.search(r"hashpartitioning\(item#\d+L?, 16\), REPARTITION_BY_NUM", plan)
        assert len(re.findall(r"hashpartitioning\(item#\d+L?, \d+\),", plan)) == 1


def test_levels_shuffle_no_bin_for_the_totals(spark):
    series = [("a", "2024-01-01", [None, 2.0, None, 4.0]), ("b", "2024-01-02", [1.0, 3.0]), ("none", "2024-01-01", [])]
    packed = spark.createDataFrame(series, "item string, start string, target array<double>").withColumn("start", F.to_timestamp("start"))
    levels = item_levels(packed, "item", prior=2.0)
    assert "SortMergeJoin" not in plan_of(levels) and "aggregate(" not in plan_of(levels)
    got = {(r["item"], r["end"]): r["level"] for r in levels.collect()}
    every = [0.0, 3 / 2, 6 / 3, 10 / 4]  # totals of all items by day
    want = {("a", 1): every[0], ("a", 2): (2 + 2 * every[1]) / 3, ("a", 3): (2 + 2 * every[2]) / 3, ("a", 4): (6 + 2 * every[3]) / 4}
    want |= {("b", 1): (1 + 2 * every[1]) / 3, ("b", 2): (4 + 2 * every[2]) / 4}
    assert got == pytest.approx(want)
