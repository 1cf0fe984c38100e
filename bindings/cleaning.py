"""Projection, filters, casts and scalar functions."""

from pyspark.sql import functions as F

from stockweave.functions.scalars import date_text, ts_text
from stockweave.operators.clean import (
    calendar_features,
    cast_columns,
    cutoff_split,
    drop_incomplete,
    fill_defaults,
    filter_if_present,
    outlier_gate,
    parse_utc,
    prefer_value,
    recode_values,
    rename_optional,
    select_features,
    share_above,
)

from .common import day, query, table


def campaign(spark, sf_dir):
    """Lineitem with its part as a campaign table; missing values where the line number is 7."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
        F.nullif("l_linenumber", F.lit(7)).alias("line"),
        "l_shipdate",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    # No hint: Spark broadcasts the part table only below its size threshold.
    return lines.join(parts, lines.l_partkey == parts.p_partkey)


CAMPAIGN = """
campaign AS (
  SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
         nullif(l_linenumber, 7) AS line, l_shipdate, p_brand, p_size, p_retailprice
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


@query(
    "select_features",
    f"WITH {CAMPAIGN} SELECT l_extendedprice, l_quantity, p_size, p_retailprice, p_brand FROM campaign",
)
def features(spark, sf_dir):
    return select_features(
        campaign(spark, sf_dir),
        "l_extendedprice",
        ["l_quantity", "p_size", "p_retailprice", "p_brand"],
    )


@query(
    "rename_optional",
    f"WITH {CAMPAIGN} SELECT l_orderkey, p_brand AS asin, p_size AS Cluster FROM campaign",
)
def renamed(spark, sf_dir):
    names = {"p_brand": "asin", "p_size": "Cluster", "advertised_asin": "asin2"}
    return rename_optional(campaign(spark, sf_dir), names).select("l_orderkey", "asin", "Cluster")


@query("parse_utc", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(hour(o_orderdate) AS INTEGER) AS h FROM orders")
def parsed(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date")
    )
    out = parse_utc(text, "date")
    return out.select("o_orderkey", day("date"), F.hour("date").alias("h"))


@query(
    "period_filter",
    "SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem WHERE l_linestatus = 'O'",
)
def period(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return filter_if_present(filter_if_present(lines, "l_linestatus", "O"), "period", "DAILY")


_VIEWS = """
WITH views AS (
  SELECT l_orderkey, l_suppkey, l_shipdate, l_returnflag, l_linestatus,
         min(l_returnflag) OVER k = max(l_returnflag) OVER k AS one
  FROM lineitem WINDOW k AS (PARTITION BY l_suppkey, l_shipdate)
)
SELECT l_orderkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, l_returnflag, l_linestatus
FROM views WHERE (one OR l_returnflag = 'R')"""


def _preferred(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    return prefer_value(lines, ["l_suppkey", "l_shipdate"], "l_returnflag", "R")


def _as_days(df):
    return df.select("l_orderkey", "l_suppkey", day("l_shipdate"), "l_returnflag", "l_linestatus")


@query("prefer_view", _VIEWS)
def preferred(spark, sf_dir):
    return _as_days(_preferred(spark, sf_dir))


@query("prefer_view_then_period", _VIEWS + " AND l_linestatus = 'O'")
def preferred_then_period(spark, sf_dir):
    return _as_days(filter_if_present(_preferred(spark, sf_dir), "l_linestatus", "O"))


@query(
    "drop_incomplete",
    f"WITH {CAMPAIGN} SELECT l_orderkey, l_partkey, line FROM campaign WHERE line IS NOT NULL",
)
def complete(spark, sf_dir):
    return drop_incomplete(campaign(spark, sf_dir)).select("l_orderkey", "l_partkey", "line")


_GATE = """
SELECT l_orderkey, l_quantity FROM lineitem
WHERE l_quantity < {limit} OR NOT (
  SELECT count(*) FILTER (l_quantity > {limit}) < 0.2::DOUBLE * count(*) FROM lineitem)"""


@query("outlier_gate", _GATE.format(limit=45))
def trimmed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return outlier_gate(lines, "l_quantity", 45, 0.2)


@query("outlier_gate_open", _GATE.format(limit=25))
def untrimmed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return outlier_gate(lines, "l_quantity", 25, 0.2)


@query(
    "share_above",
    """
SELECT count(*) FILTER (l_quantity > 45) AS n_above, count(*) AS n_rows,
       (count(*) FILTER (l_quantity > 45))::DOUBLE / count(*) AS share FROM lineitem""",
)
def above(spark, sf_dir):
    return share_above(table(spark, sf_dir, "lineitem"), "l_quantity", 45)


@query(
    "cutoff_split",
    """
SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d,
       CASE WHEN l_shipdate < TIMESTAMP '2000-12-31' THEN 'train' ELSE 'test' END AS split
FROM lineitem""",
)
def cut(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    return cutoff_split(lines, "l_shipdate", "2000-12-31").select(
        "l_orderkey", day("l_shipdate"), "split"
    )


@query(
    "fill_defaults",
    f"WITH {CAMPAIGN} SELECT l_orderkey, CAST(coalesce(line, 0) AS INTEGER) AS line FROM campaign",
)
def filled(spark, sf_dir):
    return fill_defaults(campaign(spark, sf_dir), {"line": 0}).select("l_orderkey", "line")


@query(
    "cast_columns",
    """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_orderkey AS FLOAT) AS as_float,
       CAST(left(o_orderpriority, 1) AS INTEGER) AS priority FROM orders""",
)
def casted(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderkey").alias("as_float"),
        F.left("o_orderpriority", F.lit(1)).alias("priority"),
    )
    return cast_columns(rows, {"o_custkey": "string", "as_float": "float", "priority": "int"})


@query(
    "calendar_features",
    """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def calendar(spark, sf_dir):
    return calendar_features(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate"
    )


@query(
    "format_ts",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts, strftime(o_orderdate, '%Y-%m-%d') AS d
FROM orders""",
)
def formatted(spark, sf_dir):
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", ts_text(date).alias("ts"), date_text(date).alias("d")
    )


@query(
    "recode_values",
    """
SELECT l_orderkey,
       CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS l_returnflag,
       CASE l_linestatus WHEN 'F' THEN '0' ELSE l_linestatus END AS l_linestatus
FROM lineitem""",
)
def recoded(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    lines = recode_values(lines, "l_returnflag", {"A": 0, "N": 1, "R": 2})
    return cast_columns(recode_values(lines, "l_linestatus", {"F": 0}), {"l_returnflag": "int"})
