"""Registration of queries and shared table views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL with the same result if there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> Column:
    return F.to_date(F.col(column)).alias("d")


def r6(column: str | Column) -> Column:
    """Rounded where the order of a floating-point sum may differ."""
    return F.round(column, 6)


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments as observations: item = supplier, units = quantity (whole numbers)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("item"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("units"),
    )


SUPPLY = "SELECT l_suppkey AS item, l_shipdate AS ts, l_quantity AS units FROM lineitem"


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: item = user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("item"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("units"),
        "event_type",
    )


VISITS = "SELECT user_id AS item, ts, value AS units, event_type FROM events"


def grid_sql(obs: str, agg: str) -> str:
    """CTE ``raw``: daily grid per item with the aggregated value or null."""
    return f"""
obs AS ({obs}),
bins AS (SELECT item, CAST(ts AS DATE) AS d, {agg}(units) AS v FROM obs GROUP BY 1, 2),
span AS (SELECT item, min(d) AS lo, max(d) AS hi FROM bins GROUP BY 1),
grid AS (
  SELECT item, lo, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span
),
raw AS (
  SELECT g.item, g.d, g.lo, g.hi, b.v,
         CAST(g.d - g.lo AS INTEGER) AS pos, CAST(g.hi - g.lo + 1 AS INTEGER) AS n_bins
  FROM grid g LEFT JOIN bins b ON g.item = b.item AND g.d = b.d
)"""


def line_sql(side: str = "0") -> str:
    """CTE ``series``: linear interpolation of ``raw``; ``side`` separates parts of an item."""
    part = f"PARTITION BY item, {side} ORDER BY d ROWS BETWEEN"
    return f"""
near AS (
  SELECT *,
    last_value(v IGNORE NULLS) OVER p AS pv,
    last_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER p AS pd,
    first_value(v IGNORE NULLS) OVER n AS nv,
    first_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER n AS nd
  FROM raw
  WINDOW p AS ({part} UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS ({part} CURRENT ROW AND UNBOUNDED FOLLOWING)
),
series AS (
  SELECT item, d, lo, hi, pos, n_bins,
    CASE WHEN v IS NOT NULL THEN v
         WHEN pv IS NULL THEN NULL
         WHEN nv IS NULL THEN pv
         ELSE (nv - pv) / (nd - pd) * (d - pd) + pv END AS v
  FROM near
)"""


HOLDOUT = "(d > hi - 28)"
