"""Metrics and drift checks: lines shipped before a date are the baseline, the rest is current."""

from pyspark.sql import functions as F

from stockweave.operators.metrics import regression_metrics
from stockweave.operators.quality import (
    ConstraintViolation,
    build_constraints,
    check_constraints,
    compare_baseline,
    fail_on_violation,
    quality_gate,
    statistics_report,
    violation_status,
)
from stockweave.operators.tabular import evaluate_regressor
from stockweave.session import scratch_path
from stockweave.sources.reports import load_baseline, save_baseline

from .common import query, r6, table

# Round numbers keep the metrics' text forms equal in both engines.
_METRICS = """
pairs AS (
  SELECT l_quantity AS y, CAST(l_linenumber * 7 AS DOUBLE) AS p, l_shipdate < TIMESTAMP '2000-12-31' AS old FROM lineitem
),
wide AS (
  SELECT old, CAST(count(*) AS DOUBLE) AS item_count, round(avg(abs((y - p) / (y + 0.001::DOUBLE))), 4) AS mape,
         round(avg((y - p) * (y - p)), 4) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
         round(1 - avg((y - p) * (y - p)) / var_pop(y), 4) AS r2
  FROM pairs GROUP BY old
),
long AS (UNPIVOT wide ON item_count, mape, mse, rmse, r2 INTO NAME metric VALUE value),
cur AS (SELECT metric, value FROM long WHERE NOT old),
base AS (
  SELECT metric, value AS threshold,
         CASE metric WHEN 'r2' THEN 'LessThanThreshold' ELSE 'GreaterThanThreshold' END AS operator
  FROM long WHERE old AND metric <> 'item_count'
),
compared AS (
  SELECT c.metric, value, threshold, operator,
         (operator = 'GreaterThanThreshold' AND value > threshold) OR (operator = 'LessThanThreshold' AND value < threshold) AS violated
  FROM cur c JOIN base b ON c.metric = b.metric
)"""


def _pairs(spark, sf_dir, old: bool):
    before = F.col("l_shipdate") < F.lit("2000-12-31").cast("timestamp_ntz")
    lines = table(spark, sf_dir, "lineitem").filter(before if old else ~before)
    return lines.select(
        F.col("l_quantity").alias("target"),
        (F.col("l_linenumber") * 7).cast("double").alias("predictions"),
    )


def _statistics(spark, sf_dir, old: bool):
    report = statistics_report(regression_metrics(_pairs(spark, sf_dir, old)))
    return report.withColumn("value", F.round("value", 4))


_METRIC_SQL = {
    "item_count": "count(*) AS item_count",
    "mse": "round(avg((y - p) * (y - p)), 6) AS mse",
    "rmse": "round(sqrt(avg((y - p) * (y - p))), 6) AS rmse",
    "std": "round(stddev_pop(y - p), 6) AS std",
    "mape": "round(100 * avg(abs((y - p) / (y + 0.001::DOUBLE))), 6) AS mape",
    "r2": "round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2",
}


def _metric_query(name: str, columns: list[str]) -> None:
    """Some of the metrics per return flag; Spark computes only the ones asked for."""

    @query(
        name,
        f"""
WITH pairs AS (SELECT l_returnflag, l_quantity AS y, CAST(l_linenumber * 7 AS DOUBLE) AS p FROM lineitem)
SELECT l_returnflag, {', '.join(_METRIC_SQL[c] for c in columns)} FROM pairs GROUP BY l_returnflag""",
    )
    def grouped(spark, sf_dir):
        pairs = table(spark, sf_dir, "lineitem").select(
            "l_returnflag", "l_quantity", (F.col("l_linenumber") * 7).alias("p")
        )
        out = regression_metrics(pairs, "l_quantity", "p", by=["l_returnflag"], mape_scale=100.0)
        rounded = [F.col(c) if c == "item_count" else r6(c).alias(c) for c in columns]
        return out.select("l_returnflag", *rounded)


_metric_query("regression_metrics", list(_METRIC_SQL))
_metric_query("mse_rmse", ["mse", "rmse"])
_metric_query("residual_std", ["std"])
_metric_query("mape", ["mape"])
_metric_query("r2", ["r2"])
_metric_query("item_count", ["item_count"])


@query("statistics_report", f"WITH {_METRICS} SELECT metric, value FROM cur")
def statistics(spark, sf_dir):
    return _statistics(spark, sf_dir, old=False)


@query("build_constraints", f"WITH {_METRICS} SELECT metric, threshold, operator FROM base")
def constraints(spark, sf_dir):
    return build_constraints(_statistics(spark, sf_dir, old=True))


@query("compare_baseline", f"WITH {_METRICS} SELECT metric, value, threshold, operator, violated FROM compared")
def compared(spark, sf_dir):
    base = build_constraints(_statistics(spark, sf_dir, old=True))
    return compare_baseline(_statistics(spark, sf_dir, old=False), base)


def _violations(spark, sf_dir):
    base = build_constraints(_statistics(spark, sf_dir, old=True))
    return check_constraints(_statistics(spark, sf_dir, old=False), base)


@query(
    "check_constraints",
    f"""WITH {_METRICS}
SELECT operator AS constraint_check_type, metric AS metric_name,
       metric || ' is ' || CAST(value AS VARCHAR) || ', which breaks the rule ' || operator || ' ' || CAST(threshold AS VARCHAR) AS description
FROM compared WHERE violated""",
)
def violations(spark, sf_dir):
    return _violations(spark, sf_dir)


@query(
    "fail_on_violation",
    f"""WITH {_METRICS}
SELECT count(*) AS n_violations, count(*) > 0 AS failed, count(*) > 0 AS raised, false AS raised_registering
FROM compared WHERE violated""",
)
def failed(spark, sf_dir):
    """Violations, and whether the check raises without and with registering a baseline."""
    found = _violations(spark, sf_dir)
    raised = []
    for registering in (False, True):
        try:
            fail_on_violation(found, registering)
            raised.append(False)
        except ConstraintViolation:
            raised.append(True)
    return violation_status(found).withColumns(
        {"raised": F.lit(raised[0]), "raised_registering": F.lit(raised[1])}
    )


@query(
    "quality_gate",
    f"WITH {_METRICS} SELECT 'rmse' AS metric, rmse AS value, 8.0::DOUBLE AS \"limit\", rmse <= 8.0 AS passed FROM wide WHERE NOT old",
)
def gate(spark, sf_dir):
    metrics = regression_metrics(_pairs(spark, sf_dir, old=False))
    return quality_gate(metrics.withColumn("rmse", F.round("rmse", 4)), "rmse", 8.0)


@query(
    "model_check",
    f"WITH {_METRICS} SELECT metric AS metric_name, operator AS constraint_check_type FROM compared WHERE violated",
)
def model_check(spark, sf_dir):
    """Labels and predictions of the later lines against the stored baseline of the earlier ones."""
    path = scratch_path(spark, "model-baseline")
    save_baseline(build_constraints(_statistics(spark, sf_dir, old=True)), path)
    found = check_constraints(_statistics(spark, sf_dir, old=False), load_baseline(spark, path))
    return found.select("metric_name", "constraint_check_type")


@query(
    "evaluate_regressor",
    """
WITH pairs AS (SELECT l_quantity AS y, CAST(l_linenumber * 7 AS DOUBLE) AS p FROM lineitem)
SELECT round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(stddev_pop(y - p), 6) AS std FROM pairs""",
)
def evaluated(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("label"), (F.col("l_linenumber") * 7).alias("prediction")
    )
    out = evaluate_regressor(pairs)
    return out.select(r6("rmse").alias("rmse"), r6("std").alias("std"))
