"""Round trips through files below the shared checkpoint folder."""

from pyspark.sql import functions as F

from stockweave.operators.clean import parse_utc
from stockweave.operators.encode import fit_labels
from stockweave.operators.metrics import regression_metrics
from stockweave.operators.pack import pack_series
from stockweave.operators.quality import build_constraints, check_constraints, statistics_report
from stockweave.operators.registry import (
    APPROVED,
    PENDING,
    latest_approved,
    register_model,
    registry_entry,
)
from stockweave.operators.series import resample
from stockweave.session import scratch_path
from stockweave.sources.mappings import read_mapping, write_mapping
from stockweave.sources.reports import (
    evaluation_json,
    json_metric,
    load_baseline,
    read_report,
    save_baseline,
    statistics_json,
    violations_json,
    write_report,
)
from stockweave.sources.series_json import (
    read_forecasts,
    read_series_json,
    write_forecasts,
    write_series_json,
)
from stockweave.sources.tables import capture, captured, read_observations, write_dataset

from .common import SUPPLY, day, grid_sql, query, r6, supply, table

_OBS_SCHEMA = "l_orderkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string, date string"


@query(
    "read_observations",
    "SELECT l_orderkey, l_suppkey, l_quantity, l_returnflag, CAST(l_shipdate AS DATE) AS d FROM lineitem",
)
def observations(spark, sf_dir):
    path = scratch_path(spark, "observations")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        "l_quantity",
        "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
    )
    write_dataset(rows, path, "csv")
    back = parse_utc(read_observations(spark, path, "csv", _OBS_SCHEMA), "date")
    return back.select("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", day("date"))


@query(
    "write_dataset",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def dataset(spark, sf_dir):
    path = scratch_path(spark, "dataset")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    write_dataset(table(spark, sf_dir, "orders").select(*columns), path)
    return read_observations(spark, path, "parquet")


_PACKED = f"""WITH {grid_sql(SUPPLY, 'sum')},
codes AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS cat FROM (SELECT DISTINCT item FROM raw))
SELECT cat, strftime(min(d), '%Y-%m-%d %H:%M:%S') AS start, CAST(count(*) AS INTEGER) AS n, sum(coalesce(v, 0.0::DOUBLE)) AS total
FROM raw JOIN codes USING (item) GROUP BY cat"""


def _packed(spark, sf_dir):
    regular = resample(supply(spark, sf_dir), "item", "ts", "units", "sum")
    codes = fit_labels(table(spark, sf_dir, "lineitem"), "l_suppkey")
    codes = codes.select(F.col("value").alias("item"), F.col("code").alias("cat"))
    return pack_series(regular, "item", "ts", "units").join(codes, "item")


def _summary(df):
    total = F.aggregate("target", F.lit(0.0), lambda a, x: a + x)
    return df.select("cat", "start", F.size("target").alias("n"), total.alias("total"))


@query("write_packed_series", _PACKED)
def packed_text(spark, sf_dir):
    path = scratch_path(spark, "series")
    write_series_json(_packed(spark, sf_dir), path)
    # The written lines themselves, parsed field by field.
    line = F.col("value")
    target = F.from_json(F.get_json_object(line, "$.target"), "array<double>")
    parsed = spark.read.text(path).select(
        F.get_json_object(line, "$.cat").cast("int").alias("cat"),
        F.get_json_object(line, "$.start").alias("start"),
        target.alias("target"),
    )
    return _summary(parsed)


@query("read_packed_series", _PACKED)
def packed_read(spark, sf_dir):
    path = scratch_path(spark, "series")
    write_series_json(_packed(spark, sf_dir), path)
    return _summary(read_series_json(spark, path))


@query(
    "read_forecasts",
    f"""WITH {grid_sql(SUPPLY, 'sum')},
codes AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS cat FROM (SELECT DISTINCT item FROM raw)),
tail AS (SELECT cat, d - hi + 27 AS i, coalesce(v, 0.0::DOUBLE) AS v FROM raw JOIN codes USING (item) WHERE d > hi - 28)
SELECT cat, CAST(i AS INTEGER) AS step, v AS prediction FROM tail""",
)
def forecasts_read(spark, sf_dir):
    path = scratch_path(spark, "forecasts")
    records = _packed(spark, sf_dir).select(
        "cat",
        F.create_map(F.lit("0.5"), F.slice("target", -28, 28)).alias("quantiles"),
        F.lit(None).cast("string").alias("error"),
    )
    write_forecasts(records, path)
    back = read_forecasts(spark, path, "0.5")
    return back.select("cat", F.posexplode("prediction").alias("step", "prediction"))


_BRANDS = (
    "SELECT p_brand AS value, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code "
    "FROM (SELECT DISTINCT p_brand FROM part)"
)


@query("write_mapping", _BRANDS)
def mapping_text(spark, sf_dir):
    path = scratch_path(spark, "mapping")
    write_mapping(fit_labels(table(spark, sf_dir, "part"), "p_brand"), path, "object")
    text = read_report(spark, path)
    keys = F.explode(F.json_object_keys("value")).alias("value")
    return text.select(F.col("value").alias("doc"), keys).select(
        "value",
        F.try_element_at(F.from_json("doc", "map<string,int>"), F.col("value")).alias("code"),
    )


@query("read_mapping", _BRANDS)
def mapping_read(spark, sf_dir):
    path = scratch_path(spark, "mapping")
    write_mapping(fit_labels(table(spark, sf_dir, "part"), "p_brand"), path)
    return read_mapping(spark, path)


# Quantity against its order's mean quantity stands for actual and prediction.
_PAIRS = """
pairs AS (
  SELECT l_quantity AS y, CAST(l_linenumber * 7 AS DOUBLE) AS p FROM lineitem
)"""
METRICS_SQL = f"""{_PAIRS},
metrics AS (
  SELECT count(*) AS item_count, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
         stddev_pop(y - p) AS std, avg(abs((y - p) / (y + 0.001::DOUBLE))) AS mape,
         1 - avg((y - p) * (y - p)) / var_pop(y) AS r2
  FROM pairs
)"""


def line_pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("target"),
        (F.col("l_linenumber") * 7).cast("double").alias("predictions"),
    )


@query(
    "write_report",
    f"""WITH {METRICS_SQL}
SELECT round(rmse, 6) AS rmse, round(std, 6) AS std, round(mape, 6) AS mape, round(r2, 6) AS r2, CAST(item_count AS BIGINT) AS n,
       3::BIGINT AS n_violations FROM metrics""",
)
def report(spark, sf_dir):
    metrics = regression_metrics(line_pairs(spark, sf_dir))
    evaluation, statistics = scratch_path(spark, "evaluation"), scratch_path(spark, "statistics")
    violations = scratch_path(spark, "violations")
    write_report(evaluation_json(metrics), evaluation)
    write_report(statistics_json(metrics), statistics)
    # Limits of half the errors: mape, mse and rmse break them, r2 keeps its own value.
    limits = build_constraints(statistics_report(metrics)).withColumn(
        "threshold", F.when(F.col("metric") == "r2", F.col("threshold")).otherwise(F.col("threshold") / 2)
    )
    write_report(violations_json(check_constraints(statistics_report(metrics), limits)), violations)
    doc = read_report(spark, evaluation).select(
        F.col("value").alias("e"),
        read_report(spark, statistics).scalar().alias("s"),
        read_report(spark, violations).scalar().alias("v"),
    )
    number = lambda c, path: F.get_json_object(c, path).cast("double")
    return doc.select(
        r6(number("e", "$.regression_metrics.rmse.value")).alias("rmse"),
        r6(number("e", "$.regression_metrics.rmse.standard_deviation")).alias("std"),
        r6(number("s", "$.timeseries_forecast_metrics.mape.value")).alias("mape"),
        r6(number("s", "$.timeseries_forecast_metrics.r2.value")).alias("r2"),
        number("s", "$.dataset.item_count").cast("bigint").alias("n"),
        F.json_array_length(F.get_json_object("v", "$.violations")).cast("bigint").alias("n_violations"),
    )


@query("json_metric", f"WITH {METRICS_SQL} SELECT round(rmse, 6) AS value FROM metrics")
def metric_from_json(spark, sf_dir):
    out = json_metric(evaluation_json(regression_metrics(line_pairs(spark, sf_dir))))
    return out.select(r6("value").alias("value"))


@query(
    "baseline_store",
    f"""WITH {METRICS_SQL}
SELECT metric, round(threshold, 6) AS threshold,
       CASE metric WHEN 'r2' THEN 'LessThanThreshold' ELSE 'GreaterThanThreshold' END AS operator
FROM (UNPIVOT (SELECT mape, mse, rmse, r2 FROM metrics) ON mape, mse, rmse, r2 INTO NAME metric VALUE threshold)""",
)
def baseline(spark, sf_dir):
    path = scratch_path(spark, "baseline")
    save_baseline(build_constraints(statistics_report(regression_metrics(line_pairs(spark, sf_dir)))), path)
    return load_baseline(spark, path).select("metric", r6("threshold").alias("threshold"), "operator")


@query(
    "register_model",
    f"""WITH {METRICS_SQL}
SELECT 'lines' AS model_group, 'models/2' AS uri, 'PendingManualApproval' AS status, round(rmse, 6) AS rmse FROM metrics
UNION ALL SELECT 'lines', 'models/1', 'Approved', round(rmse, 6) FROM metrics""",
)
def registered(spark, sf_dir):
    return _registry(spark, sf_dir).select(
        "model_group", "uri", "status", r6(F.col("metrics")["rmse"]).alias("rmse")
    )


@query(
    "latest_approved",
    """
WITH models AS (
  SELECT l_returnflag AS model_group, l_orderkey || '-' || l_linenumber AS uri, l_shipdate AS created FROM lineitem WHERE l_linestatus = 'F'
)
SELECT model_group, uri, CAST(created AS DATE) AS created
FROM (SELECT *, row_number() OVER (PARTITION BY model_group ORDER BY created DESC, uri DESC) AS n FROM models) WHERE n = 1""",
)
def approved(spark, sf_dir):
    """Every line stands for a registered model of its flag's group; half of them are approved."""
    registry = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model_group"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("uri"),
        F.col("l_shipdate").alias("created"),
        F.when(F.col("l_linestatus") == "F", APPROVED).otherwise(PENDING).alias("status"),
    )
    return latest_approved(registry).withColumn("created", F.to_date("created"))


def _registry(spark, sf_dir):
    path = scratch_path(spark, "registry")
    metrics = regression_metrics(line_pairs(spark, sf_dir)).select("rmse", "std")
    register_model(registry_entry(metrics, "lines", "models/1", "2024-01-01", APPROVED), path)
    register_model(registry_entry(metrics, "lines", "models/2", "2024-02-01"), path)
    return spark.read.parquet(path)


@query(
    "data_capture",
    """
SELECT o_orderkey, o_orderpriority, DATE '2024-01-31' AS run_date,
       sha256('{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}') AS inference_id
FROM orders""",
)
def captured_rows(spark, sf_dir):
    path = scratch_path(spark, "capture")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    # The second attempt of a run leaves what one attempt would.
    for attempt in (orders.limit(10), orders):
        capture(attempt, path, "2024-01-31")
    return captured(spark, path).select("o_orderkey", "o_orderpriority", "run_date", "inference_id")
