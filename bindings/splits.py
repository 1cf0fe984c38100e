"""Splits, tails, heads, copies."""

from pyspark.sql import functions as F

from stockweave.operators.pack import context_for_test, pack_series, unpack_series
from stockweave.operators.series import resample
from stockweave.operators.split import (
    head_horizon,
    median_cutoff,
    midpoint_cutoff,
    midpoint_split,
    number_rows,
    oversample,
    random_split,
    random_split_exact,
    series_split,
    tail_context,
    union_parts,
)
from stockweave.session import materialize

from .common import SUPPLY, VISITS, day, grid_sql, line_sql, query, supply, table, visits


def supplier_series(spark, sf_dir):
    return resample(supply(spark, sf_dir), "item", "ts", "units", "mean", interpolate=True)


def user_series(spark, sf_dir):
    return resample(visits(spark, sf_dir), "item", "ts", "units", "mean", interpolate=True)


_USERS = f"WITH {grid_sql(VISITS, 'avg')}, {line_sql()}"
_SUPPLIERS = f"WITH {grid_sql(SUPPLY, 'avg')}, {line_sql()}"
_CUT = "CAST(floor(n_bins * 0.85::DOUBLE) AS INTEGER)"
_PARTS = f"""
parts AS (
  SELECT item, d, v, CASE WHEN pos < {_CUT} THEN 'train' ELSE 'validation' END AS split,
         CAST(CASE WHEN pos < {_CUT} THEN pos ELSE pos - {_CUT} END AS INTEGER) AS pos,
         CAST(CASE WHEN pos < {_CUT} THEN {_CUT} ELSE n_bins - {_CUT} END AS INTEGER) AS n_bins
  FROM series
)"""


@query("series_split", f"{_SUPPLIERS}, {_PARTS} SELECT item, d, v AS units, split, pos, n_bins FROM parts")
def split(spark, sf_dir):
    return series_split(supplier_series(spark, sf_dir)).select(
        "item", day("ts"), "units", "split", "pos", "n_bins"
    )


@query(
    "tail_context",
    f"{_USERS} SELECT item, d, round(v, 9) AS units FROM series WHERE pos >= n_bins - 28",
)
def tail(spark, sf_dir):
    out = tail_context(user_series(spark, sf_dir), 28)
    return out.select("item", day("ts"), F.round("units", 9).alias("units"))


@query("head_horizon", f"{_USERS} SELECT item, d, round(v, 9) AS units FROM series WHERE pos < 28")
def head(spark, sf_dir):
    out = head_horizon(user_series(spark, sf_dir), 28)
    return out.select("item", day("ts"), F.round("units", 9).alias("units"))


@query(
    "context_for_test",
    f"""{_SUPPLIERS}, {_PARTS},
ctx AS (
  SELECT item, min(d) AS context_start, list(v ORDER BY d) AS target FROM parts
  WHERE split = 'train' AND pos >= n_bins - 28 GROUP BY 1
),
starts AS (SELECT item, min(d) AS forecast_start FROM parts WHERE split = 'validation' GROUP BY 1)
SELECT item, context_start, forecast_start, CAST(len(target) AS INTEGER) AS n,
       target[1] AS first_value, target[28] AS last_value
FROM ctx JOIN starts USING (item)""",
)
def context(spark, sf_dir):
    parts = series_split(supplier_series(spark, sf_dir))
    out = context_for_test(parts, "item", "ts", "units")
    return out.select(
        "item",
        F.to_date("context_start").alias("context_start"),
        F.to_date("forecast_start").alias("forecast_start"),
        F.size("target").alias("n"),
        F.try_element_at("target", F.lit(1)).alias("first_value"),
        F.try_element_at("target", F.lit(28)).alias("last_value"),
    )


_MIDPOINT = """
mid AS (
  SELECT d AS cutoff FROM (SELECT d, row_number() OVER (ORDER BY item, d) AS rn, count(*) OVER () AS n FROM raw)
  WHERE rn = n // 2 + 1
)"""


@query("midpoint_cutoff", f"WITH {grid_sql(SUPPLY, 'avg')}, {_MIDPOINT} SELECT cutoff FROM mid")
def midpoint(spark, sf_dir):
    out = midpoint_cutoff(supply(spark, sf_dir), "item", "ts")
    return out.select(F.to_date("cutoff").alias("cutoff"))


@query(
    "midpoint_split",
    f"""{_USERS}, {_MIDPOINT}
SELECT item, d, CASE WHEN d < (SELECT cutoff FROM mid) THEN 'train' ELSE 'test' END AS split FROM series""",
)
def midpoint_parts(spark, sf_dir):
    out = midpoint_split(user_series(spark, sf_dir), "item", "ts")
    return out.select("item", day("ts"), "split")


@query(
    "median_cutoff",
    f"""WITH {grid_sql(SUPPLY, 'avg')},
counts AS (SELECT d, count(*) AS n FROM raw GROUP BY 1),
upto AS (SELECT d, sum(n) OVER (ORDER BY d) AS c, sum(n) OVER () AS t FROM counts)
SELECT min(d) AS cutoff FROM upto WHERE c > t // 2""",
)
def median(spark, sf_dir):
    out = median_cutoff(supply(spark, sf_dir), "item", "ts")
    return out.select(F.to_date("cutoff").alias("cutoff"))


_HASH = "CAST(concat('0x', substr(md5(concat('1729|', CAST(o_orderkey AS VARCHAR))), 1, 8)) AS BIGINT)"


@query(
    "random_split",
    f"""
SELECT o_orderkey, CASE WHEN {_HASH} % 100 < 70 THEN 'train'
                        WHEN {_HASH} % 100 < 90 THEN 'validation' ELSE 'test' END AS split FROM orders""",
)
def hashed(spark, sf_dir):
    return random_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 70, 20)


@query(
    "random_split_exact",
    f"""
WITH ranked AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH}, o_orderkey) AS rn, count(*) OVER () AS n FROM orders
)
SELECT o_orderkey, CASE WHEN rn <= floor(0.7::DOUBLE * n) THEN 'train'
                        WHEN rn <= floor(0.9::DOUBLE * n) THEN 'validation' ELSE 'test' END AS split FROM ranked""",
)
def exact(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return random_split_exact(orders, "o_orderkey", 70, 20)


_LINE = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
_LINE_TEXT = ", ".join(
    f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'null')" for c in _LINE
)
_LINE_HASH = "CAST(concat('0x', substr(md5('1729|' || row_key), 1, 8)) AS BIGINT)"


@query(
    "random_split_rows",
    f"""
WITH numbered AS (
  SELECT {', '.join(_LINE)},
         sha256(concat_ws('|', {_LINE_TEXT})) || '-' || row_number() OVER (PARTITION BY {', '.join(_LINE)}) AS row_key FROM lineitem
),
ranked AS (SELECT *, row_number() OVER (ORDER BY {_LINE_HASH}, row_key) AS rn, count(*) OVER () AS n FROM numbered)
SELECT {', '.join(_LINE)}, row_key, CASE WHEN rn <= floor(0.7::DOUBLE * n) THEN 'train'
                                WHEN rn <= floor(0.9::DOUBLE * n) THEN 'validation' ELSE 'test' END AS split FROM ranked""",
)
def keyless(spark, sf_dir):
    """Exact split of lines, which have no unique column."""
    rows = materialize(number_rows(table(spark, sf_dir, "lineitem").select(*_LINE)))
    return random_split_exact(rows, "row_key", 70, 20)


@query(
    "oversample",
    f"""
SELECT o_orderkey, o_totalprice FROM orders, (SELECT unnest(generate_series(1, 8)))
WHERE {_HASH} % 100 < 70""",
)
def copies(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train = random_split(orders, "o_orderkey", 70, 20).filter("split = 'train'").drop("split")
    return oversample(train, 8)


@query("union_series", f"{_SUPPLIERS}, {_PARTS} SELECT item, d, v AS units, split FROM parts")
def union(spark, sf_dir):
    parts = series_split(supplier_series(spark, sf_dir))
    out = union_parts(
        parts.filter("split = 'train'").drop("split"),
        parts.filter("split = 'validation'").drop("split"),
    )
    return out.select("item", day("ts"), "units", "split")


@query(
    "pack_series",
    f"""WITH {grid_sql(SUPPLY, 'sum')}
SELECT item, strftime(min(d), '%Y-%m-%d %H:%M:%S') AS start,
       string_agg(CAST(CAST(coalesce(v, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY d) AS target,
       CAST(count(*) AS INTEGER) AS n
FROM raw GROUP BY item""",
)
def packed(spark, sf_dir):
    out = pack_series(resample(supply(spark, sf_dir), "item", "ts", "units", "sum"), "item", "ts", "units")
    return out.select(
        "item",
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"),
        F.array_join(F.col("target").cast("array<bigint>").cast("array<string>"), ",").alias("target"),
        F.size("target").alias("n"),
    )


@query("unpack_series", f"{_SUPPLIERS} SELECT item, d, pos, v AS units FROM series")
def unpacked(spark, sf_dir):
    rows = unpack_series(
        pack_series(supplier_series(spark, sf_dir), "item", "ts", "units"), "item", value="units"
    )
    return rows.select("item", day("ts"), "pos", "units")
