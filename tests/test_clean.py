"""Cleaning rules at their edges."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows_of
from stockweave.functions.scalars import STATUS_CODES, TARGETING_CODES
from stockweave.operators.clean import (
    calendar_features,
    cast_columns,
    drop_incomplete,
    filter_if_present,
    outlier_gate,
    parse_utc,
    prefer_value,
    prefer_value_totals,
    recode_values,
    rename_optional,
    share_above,
)

VIEWS = [
    ("one_m", "M", 1.0),
    ("one_s", "S", 2.0),
    ("one_s", "S", 3.0),
    ("one_null", None, 4.0),
    ("m_null", "M", 5.0),
    ("m_null", None, 6.0),
    ("s_null", "S", 7.0),
    ("s_null", None, 8.0),
    ("s_t", "S", 9.0),
    ("s_t", "T", 10.0),
    (None, "M", 11.0),
]


def test_prefer_value_groups(spark):
    df = spark.createDataFrame(VIEWS, "k string, view string, units double")
    kept = {r["units"] for r in prefer_value(df, ["k"], "view", "M").collect()}
    assert kept == {1.0, 2.0, 3.0, 4.0, 5.0}


def test_totals_equal_row_form(spark):
    df = spark.createDataFrame(VIEWS, "k string, view string, units double")
    rows = prefer_value(df, ["k"], "view", "M").groupBy("k").agg(F.sum("units").alias("units"))
    totals = prefer_value_totals(df, ["k"], "view", "M", "units")
    assert rows_of(totals, "k") == rows_of(rows, "k")


def test_preference_runs_before_the_period_filter(spark):
    df = spark.createDataFrame(
        [("a", "M", "WEEKLY", 1.0), ("a", "S", "DAILY", 2.0), ("b", "S", "DAILY", 3.0)],
        "k string, view string, period string, units double",
    )
    rows = filter_if_present(prefer_value(df, ["k"], "view", "M"), "period", "DAILY")
    assert [r["k"] for r in rows.collect()] == ["b"]
    totals = prefer_value_totals(df, ["k"], "view", "M", "units", {"period": "DAILY"})
    assert rows_of(totals, "k") == [("b", 3.0)]


def test_absent_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, 2)], "advertised_asin int, x int")
    assert filter_if_present(df, "period", "DAILY").columns == df.columns
    names = {"advertised_asin": "asin", "closest_cluster": "Cluster"}
    assert rename_optional(df, names).columns == ["asin", "x"]


def spend(spark, above, n=10, extra=()):
    values = [(600.0,)] * above + [(1.0,)] * (n - above) + [(v,) for v in extra]
    return spark.createDataFrame(values, "spend double")


def test_share_of_exactly_the_limit_removes_nothing(spark):
    assert outlier_gate(spend(spark, 2), "spend", 500, 0.2).count() == 10


def test_low_share_removes_above_and_equal(spark):
    assert outlier_gate(spend(spark, 1), "spend", 500, 0.2).count() == 9
    assert outlier_gate(spend(spark, 0, extra=[500.0]), "spend", 500, 0.2).count() == 10


def test_nan_is_not_above(spark):
    row = share_above(spend(spark, 1, extra=[float("nan")]), "spend", 500).first()
    assert (row["n_above"], row["n_rows"]) == (1, 11)


def test_parse_strict_and_lenient(spark):
    df = spark.createDataFrame([("2024-02-29 10:00:00",), ("nonsense",)], "date string")
    with pytest.raises(PySparkException):
        parse_utc(df, "date").collect()
    assert [r["date"] for r in parse_utc(df, "date", lenient=True).collect()] == [
        dt.datetime(2024, 2, 29, 10),
        None,
    ]


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),)], "date timestamp")
    assert [r["weekday"] for r in calendar_features(df, "date").collect()] == [0, 6]
    assert calendar_features(df, "date").columns == ["year", "weekday", "day", "month"]


def test_recoding_passes_unknown_texts_through(spark):
    df = spark.createDataFrame(
        [("Automatic targeting", "PAUSED"), ("context", "ARCHIVED"), (None, None)],
        "targeting_type string, status string",
    )
    out = recode_values(recode_values(df, "targeting_type", TARGETING_CODES), "status", STATUS_CODES)
    assert [tuple(r) for r in out.collect()] == [("0", "0"), ("2", "ARCHIVED"), (None, None)]
    with pytest.raises(PySparkException):
        cast_columns(out, {"status": "int"}).collect()


def test_incomplete_rows_drop_over_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, unused string")
    assert drop_incomplete(df).select("x").collect() == [(1,)]
