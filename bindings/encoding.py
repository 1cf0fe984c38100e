"""Category codes."""

from pyspark.sql import functions as F

from stockweave.operators.clean import drop_incomplete
from stockweave.operators.encode import encode, fit_labels, label_encode

from .common import query, table


@query(
    "label_encode",
    "SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code FROM part",
)
def brands(spark, sf_dir):
    encoded, _ = label_encode(table(spark, sf_dir, "part"), "p_brand", "code")
    return encoded.select("p_partkey", "p_brand", "code")


@query(
    "label_mapping",
    "SELECT c_name AS value, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code FROM "
    "(SELECT DISTINCT c_name FROM customer)",
)
def customers(spark, sf_dir):
    return fit_labels(table(spark, sf_dir, "customer"), "c_name")


# Codes fitted on the first year; customers who order later for the first time are unseen.
_FIRST = "o_orderdate < TIMESTAMP '1996-01-01'"
_CODES = f"""
codes AS (
  SELECT o_custkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT o_custkey FROM orders WHERE {_FIRST})
)"""


def _first_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    mapping = fit_labels(orders.filter(F.col("o_orderdate") < F.lit("1996-01-01")), "o_custkey")
    return orders.select("o_orderkey", "o_custkey"), mapping


@query(
    "encode_with_default",
    f"WITH {_CODES} SELECT o_orderkey, o.o_custkey, coalesce(code, 100) AS code "
    "FROM orders o LEFT JOIN codes c ON o.o_custkey = c.o_custkey",
)
def with_default(spark, sf_dir):
    orders, mapping = _first_year(spark, sf_dir)
    return encode(orders, mapping, "o_custkey", "code", default=100).select(
        "o_orderkey", "o_custkey", "code"
    )


@query(
    "encode_strict",
    f"WITH {_CODES} SELECT o_orderkey, o.o_custkey, code FROM orders o JOIN codes c ON o.o_custkey = c.o_custkey",
)
def strict(spark, sf_dir):
    orders, mapping = _first_year(spark, sf_dir)
    return drop_incomplete(encode(orders, mapping, "o_custkey", "code")).select(
        "o_orderkey", "o_custkey", "code"
    )
