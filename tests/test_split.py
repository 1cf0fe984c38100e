"""Splits, tails and packing."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from stockweave.operators.pack import (
    align_forecast,
    context_for_test,
    horizon_calendar,
    pack_series,
    unpack_series,
)
from stockweave.operators.series import resample
from stockweave.operators.split import (
    head_horizon,
    median_cutoff,
    number_rows,
    midpoint_cutoff,
    oversample,
    random_split,
    random_split_exact,
    series_split,
    tail_context,
    union_parts,
)

BASE = dt.datetime(2024, 1, 1)


def regular(spark, lengths, offset=0):
    rows = [
        (item, BASE + dt.timedelta(days=offset + d), float(d)) for item, n in lengths.items() for d in range(n)
    ]
    return resample(spark.createDataFrame(rows, "item string, ts timestamp, units double"), "item", "ts", "units")


@pytest.mark.parametrize("n, train", [(29, 24), (33, 28), (1, 0), (100, 85)])
def test_series_split_sizes(spark, n, train):
    parts = series_split(regular(spark, {"a": n}))
    sizes = {r["split"]: r["n"] for r in parts.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes.get("train", 0) == train and sizes["validation"] == n - train
    assert all(r["pos"] < r["n_bins"] for r in parts.collect())


def test_parts_are_disjoint_and_complete(spark):
    whole = regular(spark, {"a": 40, "b": 7})
    parts = series_split(whole)
    train = parts.filter("split = 'train'").drop("split")
    rest = parts.filter("split = 'validation'").drop("split")
    both = union_parts(train, rest)
    assert both.select("item", "ts").exceptAll(whole.select("item", "ts")).isEmpty()
    assert both.count() == whole.count()


def test_tail_and_head_of_short_series(spark):
    whole = regular(spark, {"long": 40, "short": 5})
    count = lambda df: {r["item"]: r["n"] for r in df.groupBy("item").agg(F.count("*").alias("n")).collect()}
    assert count(tail_context(whole)) == count(head_horizon(whole)) == {"long": 28, "short": 5}
    assert tail_context(whole).filter("item = 'long'").agg(F.min("units")).first()[0] == 12.0


def test_context_only_for_items_in_both_parts(spark):
    train = regular(spark, {"a": 40, "b": 3, "only_train": 5})
    test = regular(spark, {"a": 4, "b": 4, "only_test": 4}, offset=60)
    parts = union_parts(train, test)
    out = {r["item"]: r for r in context_for_test(parts, "item", "ts", "units").collect()}
    assert set(out) == {"a", "b"}
    assert out["a"]["target"] == [float(d) for d in range(12, 40)]
    assert out["b"]["target"] == [0.0, 1.0, 2.0]
    assert out["a"]["forecast_start"] == BASE + dt.timedelta(days=60)
    assert out["a"]["context_start"] == BASE + dt.timedelta(days=12)


@pytest.mark.parametrize("lengths", [{"a": 5}, {"a": 3, "b": 4, "c": 9}, {"z": 10, "y": 1, "x": 2}])
def test_midpoint_is_the_date_of_the_middle_row(spark, lengths):
    whole = regular(spark, lengths)
    rows = [r["ts"] for r in whole.orderBy("item", "ts").collect()]
    assert midpoint_cutoff(whole, "item", "ts").first()["cutoff"] == rows[len(rows) // 2]
    assert median_cutoff(whole, "item", "ts").first()["cutoff"] == sorted(rows)[len(rows) // 2]


def test_cutoffs_of_observations_equal_those_of_their_series(spark):
    rng = random.Random(4)
    rows = [(f"i{rng.randint(0, 9)}", BASE + dt.timedelta(days=rng.randint(0, 300)), 1.0) for _ in range(200)]
    raw = spark.createDataFrame(rows, "item string, ts timestamp, units double")
    whole = resample(raw, "item", "ts", "units")
    days = [r["ts"] for r in whole.orderBy("item", "ts").collect()]
    for frame in (raw, whole):
        assert midpoint_cutoff(frame, "item", "ts").first()["cutoff"] == days[len(days) // 2]
        assert median_cutoff(frame, "item", "ts").first()["cutoff"] == sorted(days)[len(days) // 2]


@pytest.mark.parametrize("n, train, val", [(1000, 70, 20), (7, 70, 20), (10, 0, 50), (10, 50, 50), (1, 10, 10)])
def test_exact_split_sizes(spark, n, train, val):
    out = random_split_exact(spark.range(n), "id", train, val)
    sizes = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    first, second = int(train * 0.01 * n), int((train + val) * 0.01 * n)
    assert sizes.get("train", 0) == first
    assert sizes.get("validation", 0) == second - first
    assert sizes.get("test", 0) == n - second


@pytest.mark.parametrize("split", [random_split, random_split_exact])
def test_split_does_not_depend_on_partitions(spark, split):
    one = rows_of(split(spark.range(500).repartition(1), "id", 70, 20), "id")
    many = rows_of(split(spark.range(500).repartition(11), "id", 70, 20), "id")
    assert one == many
    assert one != rows_of(split(spark.range(500), "id", 70, 20, seed=5), "id")


def test_oversample_repeats_each_row(spark):
    out = oversample(spark.range(3), 8).groupBy("id").count()
    assert rows_of(out, "id") == [(0, 8), (1, 8), (2, 8)]


def test_pack_then_unpack_is_identity(spark):
    whole = regular(spark, {"a": 12, "b": 3}).withColumn(
        "units", F.when(F.col("pos") == 1, F.lit(float("nan"))).otherwise(F.col("units"))
    )
    back = unpack_series(pack_series(whole, "item", "ts", "units"), "item", value="units")
    want = whole.withColumn("units", F.when(F.col("pos") != 1, F.col("units")))
    columns = ["item", "ts", "pos", "units"]
    assert rows_of(back.select(columns), "item", "pos") == rows_of(want.select(columns), "item", "pos")


def test_horizon_calendar(spark):
    starts = spark.createDataFrame([("a", dt.datetime(2024, 2, 28))], "item string, start timestamp")
    days = [r["ts"].day for r in horizon_calendar(starts, "start", 3).orderBy("step").collect()]
    assert days == [28, 29, 1]


@pytest.mark.parametrize(
    "freq, start, third",
    [
        ("H", dt.datetime(2024, 2, 28, 23), dt.datetime(2024, 2, 29, 1)),
        ("W", dt.datetime(2024, 2, 25), dt.datetime(2024, 3, 10)),
        ("M", dt.datetime(2023, 12, 31), dt.datetime(2024, 2, 29)),
        ("Y", dt.datetime(2023, 12, 31), dt.datetime(2025, 12, 31)),
    ],
)
def test_horizons_of_other_frequencies(spark, freq, start, third):
    starts = spark.createDataFrame([("a", start)], "item string, start timestamp")
    rows = horizon_calendar(starts, "start", 3, freq=freq).orderBy("step").collect()
    assert (rows[0]["ts"], rows[2]["ts"]) == (start, third)
    packed = starts.withColumn("target", F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    back = unpack_series(packed.withColumn("start", F.col("start").cast("string")), "item", freq=freq)
    assert [r["ts"] for r in back.orderBy("pos").collect()] == [r["ts"] for r in rows]


def test_alignment_cuts_dates_and_pairs_by_item(spark):
    actuals = spark.createDataFrame(
        [("a", BASE, [1.0] * 10, 0), ("b", BASE + dt.timedelta(days=5), [2.0] * 40, 1)],
        "item string, start timestamp, target array<double>, cat int",
    )
    forecasts = spark.createDataFrame(
        [("b", {"0.5": [20.0] * 28}), ("a", {"0.5": [10.0] * 28})],
        "item string, quantiles map<string,array<double>>",
    )
    rows = align_forecast(actuals, forecasts, "item").collect()
    of = lambda item: [r for r in rows if r["item"] == item]
    assert len(of("a")) == 10 and len(of("b")) == 28
    assert {(r["target"], r["predictions"], r["cat"]) for r in of("b")} == {(2.0, 20.0, 1)}
    assert min(r["start"] for r in of("b")) == BASE + dt.timedelta(days=5)
    assert max(r["start"] for r in of("a")) == BASE + dt.timedelta(days=9)


def test_numbered_rows_do_not_depend_on_partitions(spark, monkeypatch):
    from stockweave.operators import split

    monkeypatch.setattr(split, "COPIES_PER_TASK", 7)
    rows = [("a", None)] * 50 + [("a", "")] * 3 + [(None, "a")] * 2 + [("null", "null")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = lambda n: sorted(r["row_key"] for r in number_rows(df.repartition(n)).collect())
    assert keys(1) == keys(5)
    assert len(set(keys(3))) == len(rows)
    back = number_rows(df).select("x", "y").exceptAll(df)
    assert back.isEmpty() and number_rows(df).count() == len(rows)
    assert number_rows(df.limit(0)).isEmpty()
    exact = random_split_exact(number_rows(df), "row_key", 70, 20).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in exact} == {"train": 39, "validation": 11, "test": 6}
