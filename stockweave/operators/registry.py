"""Model registry rows: choosing, registering and looking up models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# Approval states of a registered model.
PENDING = "PendingManualApproval"
APPROVED = "Approved"

REGISTRY_SCHEMA = (
    "model_group string, uri string, created timestamp, status string, metrics map<string,double>"
)


def top_model(trials: DataFrame, metric: str, k: int = 1) -> DataFrame:
    """The ``k`` trials with the lowest metric; NaN and missing metrics lose, ties go to the first model or trial."""
    return (
        trials.filter(F.col(metric).isNotNull() & ~F.isnan(metric))
        .orderBy(F.col(metric), *[c for c in ("model", "trial") if c in trials.columns])
        .limit(k)
    )


def registry_entry(
    metrics: DataFrame, group: str, uri: str, created: str, status: str = PENDING
) -> DataFrame:
    """A registry row from one wide metrics row."""
    pairs = [
        F.lit(x) if isinstance(x, str) else x
        for c in metrics.columns
        for x in (c, F.col(c).cast("double"))
    ]
    return metrics.select(
        F.lit(group).alias("model_group"),
        F.lit(uri).alias("uri"),
        F.lit(created).cast("timestamp").alias("created"),
        F.lit(status).alias("status"),
        F.create_map(*pairs).alias("metrics"),
    )


def register_model(entry: DataFrame, path: str) -> None:
    """Write registry rows, one per (group, uri, status): a repeated registration replaces its row."""
    key = F.sha2(F.to_json(F.struct("model_group", "uri", "status")), 256)
    (
        entry.withColumn("entry", F.concat(F.lit("e"), key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("entry")
        .parquet(path)
    )


def register_if_passed(entry: DataFrame, gate: DataFrame, path: str) -> bool:
    """Write the entry only when the gate passed; the table exists afterwards in both cases."""
    passed = gate.first()["passed"]
    register_model(entry.filter(F.lit(passed)), path)
    return passed


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(path).drop("entry")


def approve_model(spark: SparkSession, path: str, uri: str, approved: str) -> None:
    """Write an approved row for a registered model; an unknown one raises."""
    rows = read_registry(spark, path).filter(F.col("uri") == uri).orderBy(F.desc("status")).limit(1)
    # One row, written elsewhere first: the registry is read and then written.
    rows = materialize(rows)
    if rows.isEmpty():
        raise ValueError(f"{uri} is not registered")
    when = F.lit(approved).cast("timestamp")
    register_model(rows.withColumns({"status": F.lit(APPROVED), "created": when}), path)


def approved_uri(spark: SparkSession, path: str, group: str) -> str:
    """Where the newest approved model of a group lies."""
    found = latest_approved(read_registry(spark, path), group).first()
    if found is None:
        raise ValueError(f"no approved model in group {group}")
    return found["uri"]


def latest_approved(registry: DataFrame, group: str | None = None) -> DataFrame:
    """Newest approved model per group."""
    approved = registry.filter(F.col("status") == APPROVED)
    if group is not None:
        approved = approved.filter(F.col("model_group") == group)
    return approved.groupBy("model_group").agg(
        F.max_by("uri", F.struct("created", "uri")).alias("uri"),
        F.max("created").alias("created"),
    )
