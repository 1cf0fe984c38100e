"""Resampling, grids, interpolation and per-item facts."""

from pyspark.sql import functions as F

from stockweave.functions.scalars import date_text, flag_text, ts_text
from stockweave.operators.clean import prefer_value_totals
from stockweave.operators.pack import horizon_calendar
from stockweave.operators.series import (
    min_history,
    ordered_series,
    regularize,
    resample,
    resample_with_related,
    series_counts,
    series_start,
    to_bins,
)

from .common import SUPPLY, VISITS, day, grid_sql, line_sql, query, supply, table, visits


@query(
    "resample_sum",
    f"WITH {grid_sql(SUPPLY, 'sum')} SELECT item, d, coalesce(v, 0.0::DOUBLE) AS units, pos, n_bins FROM raw",
)
def resample_sum(spark, sf_dir):
    out = resample(supply(spark, sf_dir), "item", "ts", "units", "sum")
    return out.select("item", day("ts"), "units", "pos", "n_bins")


@query("fill_grid", f"WITH {grid_sql(SUPPLY, 'sum')} SELECT item, d, v AS units FROM raw")
def fill_grid(spark, sf_dir):
    bins = to_bins(supply(spark, sf_dir), "item", "ts", {"units": "sum"})
    return regularize(bins, "item", {"units": "null"}).select("item", day("ts"), "units")


@query(
    "resample_mean",
    f"WITH {grid_sql(VISITS, 'avg')} SELECT item, d, round(v, 9) AS units FROM raw",
)
def resample_mean(spark, sf_dir):
    out = resample(visits(spark, sf_dir), "item", "ts", "units", "mean")
    return out.select("item", day("ts"), F.round("units", 9).alias("units"))


@query(
    "interpolate_linear",
    f"WITH {grid_sql(VISITS, 'avg')}, {line_sql()} SELECT item, d, round(v, 9) AS units FROM series",
)
def interpolate_linear(spark, sf_dir):
    out = resample(visits(spark, sf_dir), "item", "ts", "units", "mean", interpolate=True)
    return out.select("item", day("ts"), F.round("units", 9).alias("units"))


_LOW = "SELECT user_id AS item, ts, CASE WHEN value >= 90 THEN value END AS units FROM events"


@query(
    "interpolate_null_bins",
    f"WITH {grid_sql(_LOW, 'avg')}, {line_sql()} SELECT item, d, round(v, 9) AS units FROM series",
)
def interpolate_null_bins(spark, sf_dir):
    obs = visits(spark, sf_dir).withColumn("units", F.when(F.col("units") >= 90, F.col("units")))
    out = resample(obs, "item", "ts", "units", "mean", interpolate=True)
    return out.select("item", day("ts"), F.round("units", 9).alias("units"))


@query(
    "resample_hourly",
    """
WITH bins AS (
  SELECT user_id AS item, date_trunc('hour', ts) AS h, avg(value) AS v FROM events GROUP BY 1, 2
),
grid AS (
  SELECT item, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM bins GROUP BY item
),
raw AS (SELECT g.item, g.h, b.v FROM grid g LEFT JOIN bins b ON g.item = b.item AND g.h = b.h),
near AS (
  SELECT *,
    last_value(v IGNORE NULLS) OVER p AS pv,
    last_value(CASE WHEN v IS NOT NULL THEN h END IGNORE NULLS) OVER p AS ph,
    first_value(v IGNORE NULLS) OVER n AS nv,
    first_value(CASE WHEN v IS NOT NULL THEN h END IGNORE NULLS) OVER n AS nh
  FROM raw
  WINDOW p AS (PARTITION BY item ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY item ORDER BY h ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)
SELECT item, strftime(h, '%Y-%m-%d %H:%M:%S') AS h,
  round(CASE WHEN v IS NOT NULL THEN v
       ELSE (nv - pv) / date_diff('hour', ph, nh) * date_diff('hour', ph, h) + pv END, 9) AS units
FROM near""",
)
def resample_hourly(spark, sf_dir):
    obs = visits(spark, sf_dir)
    out = resample(obs, "item", "ts", "units", "mean", freq="H", interpolate=True)
    return out.select("item", ts_text(F.col("ts")).alias("h"), F.round("units", 9).alias("units"))


@query(
    "resample_weekly",
    """
WITH bins AS (
  SELECT l_suppkey AS item, CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS d, sum(l_quantity) AS v
  FROM lineitem GROUP BY 1, 2
),
grid AS (
  SELECT item, CAST(unnest(generate_series(min(d), max(d), INTERVAL 7 DAY)) AS DATE) AS d
  FROM bins GROUP BY item
)
SELECT g.item, g.d, coalesce(b.v, 0.0::DOUBLE) AS units
FROM grid g LEFT JOIN bins b ON g.item = b.item AND g.d = b.d""",
)
def resample_weekly(spark, sf_dir):
    out = resample(supply(spark, sf_dir), "item", "ts", "units", "sum", freq="W")
    return out.select("item", day("ts"), "units")


@query(
    "resample_monthly",
    """
WITH bins AS (
  SELECT l_partkey AS item, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, sum(l_quantity) AS v
  FROM lineitem GROUP BY 1, 2
),
grid AS (
  SELECT item, CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m
  FROM bins GROUP BY item
)
SELECT g.item, last_day(g.m) AS d, coalesce(b.v, 0.0::DOUBLE) AS units
FROM grid g LEFT JOIN bins b ON g.item = b.item AND g.m = b.m""",
)
def resample_monthly(spark, sf_dir):
    obs = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("ts"), "l_quantity"
    )
    out = resample(obs, "item", "ts", "l_quantity", "sum", freq="M")
    return out.select("item", day("ts"), F.col("l_quantity").alias("units"))


@query(
    "resample_yearly",
    """
WITH bins AS (
  SELECT o_custkey AS item, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS v
  FROM orders GROUP BY 1, 2
),
grid AS (
  SELECT item, CAST(unnest(generate_series(min(y), max(y))) AS INTEGER) AS y FROM bins GROUP BY item
)
SELECT g.item, make_date(g.y, 12, 31) AS d, CAST(coalesce(b.v, 0) AS DOUBLE) AS units
FROM grid g LEFT JOIN bins b ON g.item = b.item AND g.y = b.y""",
)
def resample_yearly(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("item"), F.col("o_orderdate").alias("ts"), F.lit(1.0).alias("units")
    )
    out = resample(obs, "item", "ts", "units", "sum", freq="Y")
    return out.select("item", day("ts"), "units")


@query(
    "min_history",
    f"WITH {grid_sql(VISITS, 'avg')} SELECT item, d, n_bins FROM raw WHERE n_bins >= 29",
)
def min_history_29(spark, sf_dir):
    out = resample(visits(spark, sf_dir), "item", "ts", "units", "mean", min_bins=29)
    return min_history(out, 29).select("item", day("ts"), "n_bins")


_BY_CUSTOMER = "SELECT o_custkey AS item, o_orderdate AS ts, 1.0::DOUBLE AS units FROM orders"


@query(
    "min_history_300",
    f"WITH {grid_sql(_BY_CUSTOMER, 'sum')} SELECT item, CAST(count(*) AS BIGINT) AS n_bins "
    "FROM raw WHERE n_bins >= 300 GROUP BY 1",
)
def min_history_300(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("item"), F.col("o_orderdate").alias("ts"), F.lit(1.0).alias("units")
    )
    return series_counts(resample(obs, "item", "ts", "units", "sum", min_bins=300), "item")


_RELATED = """
WITH base AS (
  SELECT user_id AS item, CAST(ts AS DATE) AS d, sum(CAST(value AS DECIMAL(18,2))) AS v
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
),
ads AS (
  SELECT user_id AS item, CAST(ts AS DATE) AS d, sum(CAST(value AS DECIMAL(18,2))) AS v
  FROM events WHERE event_type = 'click' GROUP BY 1, 2
),
grid AS (
  SELECT item, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d
  FROM base GROUP BY item
)
SELECT g.item, g.d, round(CAST(coalesce(b.v, 0) + coalesce(a.v, 0) AS DOUBLE), 6) AS units
FROM grid g LEFT JOIN base b ON g.item = b.item AND g.d = b.d
            LEFT JOIN ads a ON g.item = a.item AND g.d = a.d"""


@query("add_related_units", _RELATED)
def add_related_units(spark, sf_dir):
    obs = visits(spark, sf_dir)
    out = resample_with_related(
        obs.filter("event_type = 'purchase'"),
        obs.filter("event_type = 'click'"),
        "item",
        "ts",
        "units",
        "units",
    )
    return out.select("item", day("ts"), F.round("units", 6).alias("units"))


@query(
    "series_counts",
    f"WITH {grid_sql(SUPPLY, 'sum')} SELECT item, count(*) AS n_bins FROM raw GROUP BY 1",
)
def counts(spark, sf_dir):
    return series_counts(resample(supply(spark, sf_dir), "item", "ts", "units", "sum"), "item")


@query(
    "series_start",
    "SELECT l_suppkey AS item, CAST(min(l_shipdate) AS DATE) AS start FROM lineitem GROUP BY 1",
)
def start(spark, sf_dir):
    out = series_start(resample(supply(spark, sf_dir), "item", "ts", "units", "sum"), "item", "ts")
    return out.select("item", F.to_date("start").alias("start"))


@query(
    "ordered_series",
    f"WITH {grid_sql(SUPPLY, 'sum')} SELECT item, d, coalesce(v, 0.0::DOUBLE) AS units FROM raw ORDER BY item, d",
)
def ordered(spark, sf_dir):
    out = ordered_series(resample(supply(spark, sf_dir), "item", "ts", "units", "sum"), "item", "ts")
    return out.select("item", day("ts"), "units")


@query(
    "horizon_calendar",
    """
SELECT item, CAST(s - 1 AS INTEGER) AS step, CAST(hi + CAST(s AS INTEGER) AS DATE) AS d
FROM (SELECT l_suppkey AS item, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem GROUP BY 1),
     (SELECT unnest(generate_series(1, 28)) AS s)""",
)
def calendar(spark, sf_dir):
    ends = supply(spark, sf_dir).groupBy("item").agg(F.max("ts").alias("end"))
    starts = ends.select("item", F.timestamp_add("DAY", F.lit(1), F.col("end")).alias("start"))
    return horizon_calendar(starts, "start", 28).select("item", "step", day("ts"))


@query(
    "bool_flag",
    """
WITH bins AS (
  SELECT user_id AS item, CAST(ts AS DATE) AS d, avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) AS f
  FROM events GROUP BY 1, 2
),
grid AS (
  SELECT item, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM bins GROUP BY item
)
SELECT g.item, strftime(g.d, '%Y-%m-%d') AS d, coalesce(CAST(b.f AS VARCHAR), 'False') AS flag
FROM grid g LEFT JOIN bins b ON g.item = b.item AND g.d = b.d""",
)
def bool_flag(spark, sf_dir):
    obs = visits(spark, sf_dir).withColumn("flag", (F.col("event_type") == "purchase").cast("double"))
    out = resample(obs, "item", "ts", "flag", "mean")
    return out.select("item", date_text(F.col("ts")).alias("d"), flag_text(F.col("flag")).alias("flag"))


@query(
    "preferred_totals",
    """
WITH views AS (
  SELECT l_suppkey AS item, l_shipdate AS ts, l_quantity AS units, l_returnflag AS view, l_linestatus AS period,
         min(l_returnflag) OVER k = max(l_returnflag) OVER k AS one
  FROM lineitem WINDOW k AS (PARTITION BY l_suppkey, l_shipdate)
)
SELECT item, CAST(ts AS DATE) AS d, sum(units) AS units FROM views
WHERE (one OR view = 'R') AND period = 'O' GROUP BY 1, 2""",
)
def preferred_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("item"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("units"),
        F.col("l_returnflag").alias("view"),
        F.col("l_linestatus").alias("period"),
    )
    out = prefer_value_totals(rows, ["item", "ts"], "view", "R", "units", {"period": "O"})
    return out.select("item", day("ts"), "units")
