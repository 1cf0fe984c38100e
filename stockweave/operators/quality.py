"""Metric reports, constraints, violations and gates. These frames hold a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Monitored metrics with the operator that makes a violation.
METRIC_OPERATORS = {
    "mape": "GreaterThanThreshold",
    "mse": "GreaterThanThreshold",
    "rmse": "GreaterThanThreshold",
    "r2": "LessThanThreshold",
}


class ConstraintViolation(Exception):
    """A metric or profile broke its stored baseline."""


def statistics_report(metrics: DataFrame) -> DataFrame:
    """One wide metrics row as rows (metric, value), item count first of all."""
    wide = metrics.select(
        F.col("item_count").cast("double"), *[F.col(m).cast("double") for m in METRIC_OPERATORS]
    )
    return wide.unpivot([], ["item_count", *METRIC_OPERATORS], "metric", "value")


def build_constraints(statistics: DataFrame) -> DataFrame:
    """(metric, threshold, operator): the current values become thresholds."""
    operator = F.create_map(*[F.lit(x) for pair in METRIC_OPERATORS.items() for x in pair])
    return statistics.filter(F.col("metric").isin(*METRIC_OPERATORS)).select(
        "metric", F.col("value").alias("threshold"), operator[F.col("metric")].alias("operator")
    )


def _violated(value: Column, threshold: Column, operator: Column) -> Column:
    """Strict comparison; a NaN or missing side never violates."""
    broken = F.when(operator == "GreaterThanThreshold", value > threshold).when(
        operator == "LessThanThreshold", value < threshold
    )
    comparable = ~F.isnan(value) & ~F.isnan(threshold)
    return F.coalesce(broken & comparable, F.lit(False))


def compare_baseline(statistics: DataFrame, constraints: DataFrame) -> DataFrame:
    """Every constrained metric beside its threshold, and whether it is violated."""
    return statistics.join(constraints, "metric").withColumn(
        "violated", _violated(F.col("value"), F.col("threshold"), F.col("operator"))
    )


def check_constraints(statistics: DataFrame, constraints: DataFrame) -> DataFrame:
    """Violations as rows (constraint_check_type, description, metric_name)."""
    text = "%s is %s, which breaks the rule %s %s"
    return (
        compare_baseline(statistics, constraints)
        .filter("violated")
        .select(
            F.col("operator").alias("constraint_check_type"),
            F.format_string(
                text,
                F.col("metric"),
                F.col("value").cast("string"),
                F.col("operator"),
                F.col("threshold").cast("string"),
            ).alias("description"),
            F.col("metric").alias("metric_name"),
        )
    )


def violation_status(violations: DataFrame) -> DataFrame:
    """One row: number of violations and whether the job fails."""
    n = F.count(F.lit(1))
    return violations.agg(n.alias("n_violations"), (n > 0).alias("failed"))


def fail_on_violation(violations: DataFrame, registering: bool = False) -> None:
    """Raise if there is any violation; a run that registers a baseline never fails on one."""
    if not registering and not violations.isEmpty():
        names = [r[0] for r in violations.select("metric_name").distinct().limit(20).collect()]
        raise ConstraintViolation(f"metrics outside their limits: {', '.join(sorted(map(str, names)))}")


def quality_gate(metrics: DataFrame, metric: str, limit: float) -> DataFrame:
    """One row (metric, value, limit, passed): passed when the value is at most the limit."""
    value = F.col(metric).cast("double")
    passed = F.coalesce((value <= limit) & ~F.isnan(value), F.lit(False))
    return metrics.select(
        F.lit(metric).alias("metric"),
        value.alias("value"),
        F.lit(float(limit)).alias("limit"),
        passed.alias("passed"),
    )
