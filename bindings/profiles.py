"""Column profiles of orders before and after a date."""

from pyspark.sql import functions as F

from stockweave.operators.profile import (
    category_distance,
    category_profile,
    column_profile,
    data_check,
    distribution_distance,
)
from stockweave.operators.profile_state import merge_states, profile_of, profile_state
from stockweave.session import scratch_path
from stockweave.sources.profiles import read_states, write_states

from .common import query, r6, table

_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
_CUT = "1998-06-30"


def _orders(spark, sf_dir, old=None):
    orders = table(spark, sf_dir, "orders")
    if old is not None:
        before = F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz")
        orders = orders.filter(before if old else ~before)
    return orders.select(*_COLUMNS)


def _column_sql(name: str, kind: str) -> str:
    numeric = kind != "string"
    x = f"CAST({name} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    q = [f"quantile_cont({x}, {p})" if numeric else "CAST(NULL AS DOUBLE)" for p in (0.1, 0.5, 0.9)]
    return f"""
SELECT '{name}' AS "column", '{kind}' AS data_type, count(*) AS n_rows, count({name}) AS n_present,
       count({name})::DOUBLE / count(*) AS completeness, count(DISTINCT {name}) AS n_distinct,
       min({x}) AS min, max({x}) AS max, round(sum({x}), 2) AS sum, round(avg({x}), 6) AS mean,
       round(stddev_pop({x}), 4) AS std, min({x}) >= 0 AS non_negative,
       round({q[0]}, 4) AS p10, round({q[1]}, 4) AS p50, round({q[2]}, 4) AS p90
FROM orders"""


_KINDS = ["bigint", "bigint", "double", "string", "string"]


@query("column_profile", " UNION ALL ".join(map(_column_sql, _COLUMNS, _KINDS)))
def profile(spark, sf_dir):
    out = column_profile(_orders(spark, sf_dir), exact=True)
    decile = lambda i: F.round(F.col("deciles")[i], 4)
    return out.select(
        "column",
        "data_type",
        "n_rows",
        "n_present",
        "completeness",
        "n_distinct",
        "min",
        "max",
        F.round("sum", 2).alias("sum"),
        r6("mean").alias("mean"),
        F.round("std", 4).alias("std"),
        "non_negative",
        decile(0).alias("p10"),
        decile(4).alias("p50"),
        decile(8).alias("p90"),
    )


def _sketch_sql(name: str, kind: str) -> str:
    numeric = kind != "string"
    x = f"CAST({name} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    near = "true" if numeric else "CAST(NULL AS BOOLEAN)"
    return f"""
SELECT '{name}' AS "column", '{kind}' AS data_type, count(*) AS n_rows, count({name}) AS n_present,
       min({x}) AS min, max({x}) AS max, round(avg({x}), 6) AS mean, true AS distinct_near, {near} AS deciles_near
FROM orders"""


@query("column_profile_sketch", " UNION ALL ".join(map(_sketch_sql, _COLUMNS, _KINDS)))
def sketch(spark, sf_dir):
    """The one-pass profile; its sketches are held against the exact distinct counts and deciles."""
    orders = _orders(spark, sf_dir)
    exact = column_profile(orders, exact=True).select(
        "column", F.col("n_distinct").alias("true_distinct"), F.col("deciles").alias("true_deciles")
    )
    distinct_near = F.abs(F.col("n_distinct") - F.col("true_distinct")) <= 0.15 * F.col("true_distinct")
    gaps = F.zip_with("deciles", "true_deciles", lambda a, b: F.abs(a - b))
    deciles_near = F.array_max(gaps) <= 0.01 * (F.col("max") - F.col("min"))
    return column_profile(orders).join(exact, "column").select(
        "column",
        "data_type",
        "n_rows",
        "n_present",
        "min",
        "max",
        r6("mean").alias("mean"),
        distinct_near.alias("distinct_near"),
        deciles_near.alias("deciles_near"),
    )


@query(
    "data_check",
    """
WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-30'),
new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-30')
SELECT 'o_orderdate' AS "column", 'missing_column' AS "check" FROM (SELECT count(*) FROM old)
UNION ALL SELECT 'discount', 'extra_column' FROM (SELECT count(*) FROM new)
UNION ALL SELECT 'o_custkey', 'data_type' FROM (SELECT count(*) FROM new)
UNION ALL SELECT 'o_orderpriority', 'completeness' FROM new WHERE o_orderpriority = '5-LOW' GROUP BY 1, 2
UNION ALL SELECT 'o_totalprice', 'non_negative' FROM new GROUP BY 1, 2 HAVING min(-o_totalprice) < 0""",
)
def check(spark, sf_dir):
    """The later orders with one deviation per rule."""
    orders = table(spark, sf_dir, "orders")
    before = F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz")
    old = orders.filter(before)
    new = orders.filter(~before).select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        (-F.col("o_totalprice")).alias("o_totalprice"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.lit(0.1).alias("discount"),
    )
    return data_check(column_profile(new), column_profile(old)).select("column", "check")


def _distance_sql(name: str) -> str:
    levels = ", ".join(str(i / 10) for i in range(1, 10))
    return f"""
SELECT '{name}' AS "column", round(max(abs(coalesce(n, 0)::DOUBLE / t - 0.1::DOUBLE)), 6) AS distance
FROM (SELECT unnest(generate_series(0, 9)) AS b) bins
LEFT JOIN (
  SELECT len(list_filter(e.q, lambda x: x < CAST({name} AS DOUBLE))) AS b, count(*) AS n
  FROM new, (SELECT quantile_cont(CAST({name} AS DOUBLE), [{levels}]) AS q FROM old) e GROUP BY 1
) counted ON counted.b = bins.b, (SELECT count(*) AS t FROM new) total"""


@query(
    "distribution_distance",
    f"""WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'),
new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{_CUT}')
{_distance_sql('o_custkey')} UNION ALL {_distance_sql('o_totalprice')}""",
)
def distance(spark, sf_dir):
    columns = ["o_custkey", "o_totalprice"]
    baseline = column_profile(_orders(spark, sf_dir, old=True).select(*columns), exact=True)
    out = distribution_distance(_orders(spark, sf_dir, old=False).select(*columns), baseline)
    return out.select("column", r6("distance").alias("distance"))


_TEXTS = {"o_orderpriority": "o_orderpriority", "o_orderstatus": "o_orderstatus", "o_day": "CAST(o_orderdate AS DATE)", "large": "o_totalprice > 150000"}
_TOP = 3


def _listed_sql(name: str, x: str) -> str:
    return f"""
SELECT '{name}' AS "column", value, n, n::DOUBLE / sum(n) OVER () AS share
FROM (SELECT CASE WHEN place <= {_TOP} THEN v END AS value, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT *, row_number() OVER (ORDER BY n DESC, v) AS place FROM (SELECT CAST({x} AS VARCHAR) AS v, count(*) AS n FROM {{rows}} WHERE {x} IS NOT NULL GROUP BY 1)
) GROUP BY 1)"""


def _texts(spark, sf_dir, old=None):
    orders = table(spark, sf_dir, "orders")
    if old is not None:
        before = F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz")
        orders = orders.filter(before if old else ~before)
    return orders.select("o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("o_day"), (F.col("o_totalprice") > 150000).alias("large"))


# A column of few values has an empty rest, which grouping does not show.
@query(
    "category_profile",
    "SELECT \"column\", value, n, round(share, 9) AS share FROM ("
    + " UNION ALL ".join(_listed_sql(*x).format(rows="orders") for x in _TEXTS.items())
    + ") WHERE n > 0",
)
def category(spark, sf_dir):
    out = category_profile(_texts(spark, sf_dir), top=_TOP).filter("n > 0")
    return out.select("column", "value", "n", F.round("share", 9).alias("share"))


def _category_distance_sql(name: str, x: str) -> str:
    return f"""
SELECT '{name}' AS "column", round(max(abs(coalesce(a.share, 0) - coalesce(b.share, 0))), 9) AS distance
FROM (SELECT coalesce(value, '') AS value, share FROM ({_listed_sql(name, x).format(rows='old')})) a
FULL JOIN (
  SELECT CASE WHEN CAST({x} AS VARCHAR) IN (SELECT value FROM ({_listed_sql(name, x).format(rows='old')}) WHERE value IS NOT NULL) THEN CAST({x} AS VARCHAR) ELSE '' END AS value,
         count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM new GROUP BY 1
) b ON a.value = b.value"""


@query(
    "category_distance",
    f"""WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'),
new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{_CUT}')
"""
    + " UNION ALL ".join(_category_distance_sql(*x) for x in _TEXTS.items()),
)
def category_drift(spark, sf_dir):
    baseline = category_profile(_texts(spark, sf_dir, old=True), top=_TOP)
    out = category_distance(_texts(spark, sf_dir, old=False), baseline)
    return out.select("column", F.round("distance", 9).alias("distance"))


def _merged_sql(name: str, kind: str) -> str:
    numeric = kind != "string"
    x = f"CAST({name} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    near = "true" if numeric else "CAST(NULL AS BOOLEAN)"
    return f"""
SELECT '{name}' AS "column", '{kind}' AS data_type, count(*) AS n_rows, count({name}) AS n_present,
       count({name})::DOUBLE / count(*) AS completeness, min({x}) AS min, max({x}) AS max, round(sum({x}), 2) AS sum,
       round(avg({x}), 6) AS mean, round(stddev_pop({x}), 4) AS std, min({x}) >= 0 AS non_negative,
       true AS distinct_near, {near} AS deciles_near
FROM orders"""


@query("profile_merged", " UNION ALL ".join(map(_merged_sql, _COLUMNS, _KINDS)))
def merged(spark, sf_dir):
    """States of each month's orders, stored by date and merged, against the profile of all rows."""
    orders = table(spark, sf_dir, "orders").withColumn("run_date", F.trunc(F.to_date("o_orderdate"), "month"))
    path = scratch_path(spark, "states")
    write_states(profile_state(orders.select(*_COLUMNS, "run_date"), by=["run_date"]), path)
    out = profile_of(merge_states(read_states(spark, path)))
    exact = column_profile(_orders(spark, sf_dir), exact=True).select(
        "column", F.col("n_distinct").alias("true_distinct"), F.col("deciles").alias("true_deciles")
    )
    gaps = F.zip_with("deciles", "true_deciles", lambda a, b: F.abs(a - b))
    return out.join(exact, "column").select(
        "column",
        "data_type",
        "n_rows",
        "n_present",
        "completeness",
        "min",
        "max",
        F.round("sum", 2).alias("sum"),
        r6("mean").alias("mean"),
        F.round("std", 4).alias("std"),
        "non_negative",
        (F.abs(F.col("n_distinct") - F.col("true_distinct")) <= 0.08 * F.col("true_distinct")).alias("distinct_near"),
        (F.array_max(gaps) <= 0.02 * (F.col("max") - F.col("min"))).alias("deciles_near"),
    )
