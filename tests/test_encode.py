"""Codes: order, unseen values, and the paths for many values."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows_of
from stockweave.operators.encode import encode, fit_labels, label_encode
from stockweave.operators.ordering import running_total
from stockweave.session import scratch_path
from stockweave.sources.mappings import read_mapping, write_mapping


def test_codes_follow_sorted_values(spark):
    values = [f"Brand#{i}" for i in range(1, 31)] * 3
    df = spark.createDataFrame([(v,) for v in values], "brand string")
    mapping = {r["value"]: r["code"] for r in fit_labels(df, "brand").collect()}
    assert mapping == {v: i for i, v in enumerate(sorted(set(values)))}


def test_many_values_over_many_partitions(spark):
    names = [f"{random.Random(i).random():.12f}" for i in range(20_000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(16)
    got = [r["value"] for r in fit_labels(df, "name").orderBy("code").collect()]
    assert got == sorted(set(names))


def test_nulls_get_no_code(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    encoded, _ = label_encode(df, "v", "code")
    assert rows_of(encoded, F.col("v").asc_nulls_last()) == [("a", 0), ("b", 1), (None, None)]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_unseen_values_with_and_without_broadcast(spark, threshold):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        _unseen_values(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def _unseen_values(spark):
    mapping = spark.createDataFrame([("a", 0), ("b", 1)], "value string, code int")
    df = spark.createDataFrame([("a",), ("z",), ("b",)], "item string")
    filled = encode(df, mapping, "item", "code", default=100)
    assert rows_of(filled.select("item", "code"), "item") == [("a", 0), ("b", 1), ("z", 100)]
    strict = encode(df, mapping, "item", "code")
    assert rows_of(strict.select("item", "code"), "item") == [("a", 0), ("b", 1), ("z", None)]


def test_a_fitted_mapping_is_written_and_sized(spark):
    """Its file size lets Spark broadcast it, and no use numbers the values again."""
    df = spark.createDataFrame([(f"v{i % 9}",) for i in range(90)], "v string")
    encoded, mapping = label_encode(df, "v", "code")
    assert "Window" not in plan_of(mapping)
    assert "BroadcastHashJoin" in plan_of(encoded)


def test_running_total_equals_prefix_sum(spark):
    rng = random.Random(3)
    weights = {k: rng.randint(0, 9) for k in rng.sample(range(100_000), 5_000)}
    df = spark.createDataFrame(list(weights.items()), "k long, w long").repartition(13)
    got = {r["k"]: r["t"] for r in running_total(df, ["k"], "w", "t").collect()}
    total, want = 0, {}
    for k in sorted(weights):
        total += weights[k]
        want[k] = total
    assert got == want


@pytest.mark.parametrize("form", ["lines", "object"])
def test_mapping_round_trip(spark, form):
    rows = [(f"näme \"{i}\"", i) for i in range(5)]
    mapping = spark.createDataFrame(rows, "value string, code int")
    path = scratch_path(spark, "mapping")
    assert write_mapping(mapping, path, form) == form
    assert rows_of(read_mapping(spark, path, form), "code") == rows


def test_large_mapping_comes_back_whole(spark):
    n = 120_000
    mapping = spark.range(n).selectExpr("concat('v', id) AS value", "CAST(id AS INT) AS code")
    path = scratch_path(spark, "mapping")
    write_mapping(mapping, path)
    back = read_mapping(spark, path)
    assert back.count() == n and back.exceptAll(mapping).isEmpty()
    with pytest.raises(ValueError):
        write_mapping(mapping, scratch_path(spark, "mapping"), "object")
