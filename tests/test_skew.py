"""One key holds a third of all rows: results stay whole and hot keys do not gather raw rows."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import executed_plan
from stockweave.operators.clean import prefer_value, prefer_value_totals
from stockweave.operators.encode import encode, fit_labels
from stockweave.operators.series import resample, to_bins
from stockweave.operators.skew import MIN_SLICE_ROWS, slice_hot_keys

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Item 0 has a third of the rows, half of them on one day."""
    i = F.col("id")
    item = F.when(i % 3 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(500)))
    day = F.when(i % 6 == 0, 3).otherwise(F.pmod(F.hash(i + 1), F.lit(40)))
    view = F.element_at(F.array(F.lit("M"), F.lit("S"), F.lit(None)), F.pmod(F.hash(i + 2), F.lit(3)) + 1)
    return (
        spark.range(N)
        .repartition(16)
        .select(
            item.cast("string").alias("item"),
            F.timestamp_add("DAY", day, F.lit("2024-01-01").cast("timestamp")).alias("ts"),
            view.alias("view"),
            F.pmod(F.hash(i + 3), F.lit(100)).cast("double").alias("units"),
        )
    )


def test_map_side_combine_bounds_what_a_hot_item_sends(spark, skewed):
    plan = executed_plan(to_bins(skewed, "item", "ts", {"units": "sum"}))
    assert re.search(r"HashAggregate\(keys=\[item.*partial_sum", plan)
    regular = resample(skewed, "item", "ts", "units")
    want = defaultdict(float)
    for r in skewed.collect():
        want[(r["item"], r["ts"])] += r["units"]
    got = {(r["item"], r["ts"]): r["units"] for r in regular.collect()}
    assert sum(got.values()) == sum(want.values())
    assert all(got[k] == v for k, v in want.items())


def brute_force(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["item"], r["ts"])].append(r)
    kept = []
    for group in groups.values():
        one = len({r["view"] for r in group}) == 1
        kept += [r for r in group if one or r["view"] == "M"]
    return kept


@pytest.mark.parametrize("min_slice", [MIN_SLICE_ROWS, 500])
def test_preference_under_skew(spark, skewed, min_slice):
    want = brute_force(skewed.collect())
    out = prefer_value(skewed, ["item", "ts"], "view", "M", min_slice)
    key = lambda r: (r["item"], r["ts"], r["view"] or "", r["units"])
    assert sorted(map(key, out.collect())) == sorted(map(key, want))
    totals = prefer_value_totals(skewed, ["item", "ts"], "view", "M", "units")
    sums = defaultdict(float)
    for r in want:
        sums[(r["item"], r["ts"])] += r["units"]
    assert {(r["item"], r["ts"]): r["units"] for r in totals.collect()} == dict(sums)


def test_hot_keys_are_spread_and_others_are_not(spark, skewed):
    keys = ["item", "ts"]
    per_key = skewed.groupBy(*keys).agg(F.count("*").alias("n"))
    rows, copies, on = slice_hot_keys(skewed, per_key, keys, "n", min_slice=500)
    hottest = per_key.agg(F.max("n")).first()[0]
    sizes = rows.groupBy(*on).count()
    assert hottest > 5000 and sizes.agg(F.max("count")).first()[0] < 1000
    assert sizes.agg(F.sum("count")).first()[0] == N
    extra = copies.filter("_slice > 0").select(*keys).distinct()
    assert extra.count() == per_key.filter("n > 500").count()
    assert sizes.join(copies, on, "left_anti").isEmpty()
    assert slice_hot_keys(skewed, per_key, keys, "n") == (skewed, per_key, keys)


def test_row_order_does_not_move_rows_between_slices(spark, skewed):
    keys = ["item", "ts"]
    per_key = skewed.groupBy(*keys).agg(F.count("*").alias("n"))
    count = lambda df: sorted(
        map(tuple, slice_hot_keys(df, per_key, keys, "n", 500)[0].groupBy("_slice").count().collect())
    )
    assert count(skewed) == count(skewed.sortWithinPartitions("units"))


def test_adaptive_execution_can_split_the_unsliced_join(spark, skewed):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert "skew=true" in executed_plan(prefer_value(skewed, ["item", "ts"], "view", "M"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_codes_of_a_hot_value(spark, skewed):
    mapping = fit_labels(skewed, "item")
    out = encode(skewed, mapping, "item", "code")
    assert out.count() == N and out.filter("code IS NULL").isEmpty()
    items = sorted({r["item"] for r in skewed.select("item").distinct().collect()})
    assert out.filter("item = '0'").select("code").distinct().collect() == [(items.index("0"),)]


def test_result_does_not_depend_on_partitions(spark, skewed):
    rng = random.Random(1)
    one = resample(skewed.repartition(rng.randint(1, 4)), "item", "ts", "units")
    two = resample(skewed.repartition(23), "item", "ts", "units")
    assert one.exceptAll(two).isEmpty()
