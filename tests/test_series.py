"""Regular series against pandas, and edge cases of bins, gaps and nulls."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from stockweave.operators.series import (
    add_related,
    long_enough,
    min_history,
    ordered_series,
    regularize,
    resample,
    resample_with_related,
    to_bins,
    with_positions,
)

SCHEMA = "item string, ts timestamp, units double"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(seed=7, items=5, n=300, missing=0.2):
    rng = np.random.default_rng(seed)
    start = pd.Timestamp("2022-11-20")
    minutes = rng.integers(0, 60 * 24 * 200, n)
    return pd.DataFrame(
        {
            "item": [f"i{k}" for k in rng.integers(0, items, n)],
            "ts": [start + pd.Timedelta(minutes=int(m)) for m in minutes],
            "units": np.where(rng.random(n) < missing, np.nan, rng.integers(0, 90, n).astype(float)),
        }
    )


def by_pandas(pdf, freq, how, interpolate):
    out = []
    for item, group in pdf.groupby("item"):
        series = getattr(group.set_index("ts")["units"].resample(freq), how)()
        if interpolate:
            series = series.interpolate(method="linear")
        out += [(item, t.to_pydatetime(), v) for t, v in series.items()]
    return out


@pytest.mark.parametrize(
    "freq, pandas_freq",
    [("D", "D"), ("H", "h"), ("30min", "30min"), ("W", "W"), ("M", "ME"), ("Y", "YE")],
)
@pytest.mark.parametrize("how", ["sum", "mean"])
def test_resample_equals_pandas(spark, freq, pandas_freq, how):
    pdf = random_rows()
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp"))
    got = resample(df, "item", "ts", "units", how, freq, interpolate=True)
    got = [(r["item"], r["ts"], r["units"]) for r in got.orderBy("item", "ts").collect()]
    want = by_pandas(pdf, pandas_freq, how, interpolate=True)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    a = np.array([np.nan if g[2] is None else g[2] for g in got])
    b = np.array([w[2] for w in want])
    np.testing.assert_allclose(a, b, rtol=0, atol=1e-9, equal_nan=True)


def test_null_bins_sum_and_mean(spark):
    # Days 2, 3 and 5 are absent; days 1 and 7 hold only nulls.
    df = frame(
        spark, [("a", at(1), None), ("a", at(4), 4.0), ("a", at(6), 10.0), ("a", at(7), None)]
    )
    total = resample(df, "item", "ts", "units", "sum").orderBy("ts")
    line = resample(df, "item", "ts", "units", "mean", interpolate=True).orderBy("ts")
    assert [r["units"] for r in total.collect()] == [0, 0, 0, 4, 0, 10, 0]
    assert [r["units"] for r in line.collect()] == [None, None, None, 4, 7, 10, 10]
    assert [(r["pos"], r["n_bins"]) for r in line.collect()] == [(i, 7) for i in range(7)]


def test_nan_counts_as_missing(spark):
    df = frame(spark, [("a", at(1), float("nan")), ("a", at(1), 3.0), ("a", at(2), float("nan"))])
    out = resample(df, "item", "ts", "units", "mean", interpolate=True).orderBy("ts")
    assert [r["units"] for r in out.collect()] == [3.0, 3.0]


def test_missing_item_or_time_drops_out(spark):
    df = frame(spark, [(None, at(1), 1.0), ("a", None, 1.0), ("a", at(2), 5.0)])
    assert rows_of(resample(df, "item", "ts", "units").select("item", "units"), "item") == [("a", 5.0)]


def test_single_bin_item(spark):
    out = resample(frame(spark, [("a", at(3, 5), 2.0)]), "item", "ts", "units").collect()
    assert [(r["ts"], r["units"], r["pos"], r["n_bins"]) for r in out] == [(at(3), 2.0, 0, 1)]


def test_grid_has_no_gaps_and_min_bins(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [
        (f"n{n}", base + dt.timedelta(days=d), 1.0) for n in (1, 28, 29, 33) for d in {0, n - 1}
    ]
    regular = resample(frame(spark, rows), "item", "ts", "units")
    per_item = regular.groupBy("item").agg(
        F.count("*").alias("n"), F.countDistinct("pos").alias("p"), F.max("pos").alias("hi")
    )
    assert all(r["n"] == r["p"] == r["hi"] + 1 for r in per_item.collect())
    kept = {r["item"] for r in min_history(regular, 29).select("item").distinct().collect()}
    early = resample(frame(spark, rows), "item", "ts", "units", min_bins=29)
    assert kept == {"n29", "n33"} == {r["item"] for r in early.select("item").distinct().collect()}
    bins = long_enough(to_bins(frame(spark, rows), "item", "ts", {"units": "sum"}), "item", 29)
    assert {r["item"] for r in bins.collect()} == kept


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_chunks_change_nothing(spark, chunk):
    df = spark.createDataFrame(random_rows(missing=0.5)).withColumn("ts", F.col("ts").cast("timestamp"))
    bins = to_bins(df, "item", "ts", {"units": "mean"})
    cut = lambda first, last: first + 60
    whole = regularize(bins, "item", {"units": "linear"}, cut=cut)
    parts = regularize(bins, "item", {"units": "linear"}, cut=cut, chunk_bins=chunk)
    assert whole.count() == parts.count()
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_cut_interpolates_each_side_alone(spark):
    df = frame(spark, [("a", at(1), 1.0), ("a", at(3), 3.0), ("a", at(8), 8.0), ("a", at(10), 10.0)])
    bins = to_bins(df, "item", "ts", {"units": "mean"})
    out = regularize(bins, "item", {"units": "linear"}, cut=lambda first, last: first + 4)
    values = [r["units"] for r in out.orderBy("ts").collect()]
    assert values == [1, 2, 3, 3, None, None, None, 8, 9, 10]
    assert {r["cut_pos"] for r in out.collect()} == {4}


def test_several_values_with_own_fill(spark):
    rows = [("a", at(1), 2.0, 1.0), ("a", at(3), None, 0.0), ("a", at(4), 5.0, None)]
    df = spark.createDataFrame(rows, SCHEMA + ", flag double")
    bins = to_bins(df, "item", "ts", {"units": "mean", "flag": "mean"})
    out = regularize(bins, "item", {"units": "linear", "flag": "null"})
    got = [(r["units"], r["flag"]) for r in out.orderBy("ts").collect()]
    assert got == [(2.0, 1.0), (3.0, None), (4.0, 0.0), (5.0, None)]


def test_related_units_equal_join_of_both_grids(spark):
    base = spark.createDataFrame(random_rows(1, items=4)).withColumn("ts", F.col("ts").cast("timestamp"))
    ads = spark.createDataFrame(random_rows(2, items=6)).withColumn("ts", F.col("ts").cast("timestamp"))
    fused = resample_with_related(base, ads, "item", "ts", "units", "units")
    joined = add_related(
        resample(base, "item", "ts", "units"),
        resample(ads, "item", "ts", "units"),
        ["item", "ts"],
        "units",
        "units",
    )
    assert fused.exceptAll(joined).isEmpty() and joined.exceptAll(fused).isEmpty()


def test_with_positions(spark):
    regular = resample(frame(spark, [("a", at(1), 1.0), ("a", at(9), 1.0)]), "item", "ts", "units")
    again = with_positions(regular.drop("pos", "n_bins"), "item", "ts").select(regular.columns)
    assert again.exceptAll(regular).isEmpty()


def test_ordered_series_is_globally_ordered(spark):
    df = spark.createDataFrame(random_rows(n=2000)).withColumn("ts", F.col("ts").cast("timestamp"))
    got = [(r["item"], r["ts"]) for r in ordered_series(df, "item", "ts").collect()]
    assert got == sorted(got)


def test_dates_before_1970(spark):
    rows = [("a", dt.datetime(1969, 12, 28), 1.0), ("a", dt.datetime(1969, 12, 30), 2.0)]
    for freq, want in [("D", 3), ("W", 2), ("M", 1), ("H", 49)]:
        assert resample(frame(spark, rows), "item", "ts", "units", freq=freq).count() == want
    weeks = resample(frame(spark, rows), "item", "ts", "units", freq="W").orderBy("ts").collect()
    assert [r["ts"] for r in weeks] == [dt.datetime(1969, 12, 28), dt.datetime(1970, 1, 4)]
