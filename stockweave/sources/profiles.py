"""Stored profile states, one partition per run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = (
    "column string, data_type string, n_rows long, n_present long, min double, max double, sum double, "
    "squares double, distinct binary, quantiles binary, run_date date"
)


def write_states(states: DataFrame, path: str, run_date: str | None = None) -> None:
    """Store states below their run date, given or a column of theirs; a repeated run replaces its own dates only."""
    dated = states if run_date is None else states.withColumn("run_date", F.lit(run_date).cast("date"))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


def read_states(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The stored states of the run dates from ``since`` up to and including ``until``; only their files are read."""
    states = spark.read.schema(STATE_SCHEMA).parquet(path)
    if since is not None:
        states = states.filter(F.col("run_date") >= F.lit(since).cast("date"))
    if until is not None:
        states = states.filter(F.col("run_date") <= F.lit(until).cast("date"))
    return states
