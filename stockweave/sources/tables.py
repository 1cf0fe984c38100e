"""Observation tables, datasets and captured scoring rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_observations(
    spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | str | None = None
) -> DataFrame:
    """A file or directory of observations; CSV has a header.

    Give a schema for large CSV input: without one, Spark reads the files twice
    to infer it, and reads a column of dates as timestamps.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True).option("preferDate", False)
        return reader.csv(path)
    return reader.format(fmt).load(path)


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", header).csv(path)
    else:
        writer.format(fmt).save(path)


def with_inference_id(df: DataFrame) -> DataFrame:
    """Adds ``inference_id``, a hash of the row's content: a repeated run gives the same ids."""
    return df.withColumn("inference_id", F.sha2(F.to_json(F.struct(*df.columns)), 256))


def capture(df: DataFrame, path: str, run_date: str, run_id: str = "0") -> None:
    """Write scored rows below their run date and run, then publish the run.

    A repeated run replaces what an earlier attempt left, and only that. The manifest, one row per run, is
    written last: ``captured`` reads published runs only.
    """
    spark, run = df.sparkSession, f"run-{run_id}"
    (
        with_inference_id(df)
        .withColumns({"run_date": F.lit(run_date).cast("date"), "run_id": F.lit(run)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "run_id")
        .parquet(path)
    )
    # Without rows nothing is replaced: the manifest then hides an earlier attempt.
    n_rows = 0 if df.isEmpty() else spark.read.parquet(f"{path}/run_date={run_date}/run_id={run}").count()
    manifest = spark.createDataFrame([(run_date, run, n_rows)], "run_date string, run_id string, n_rows long")
    manifest.write.mode("overwrite").json(f"{path}/_runs/{run_date}/{run}")


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """run_date, run_id, n_rows of every published run."""
    runs = spark.read.schema("run_date string, run_id string, n_rows long").json(f"{path}/_runs/*/*")
    return runs.withColumn("run_date", F.col("run_date").cast("date"))


def captured(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all published runs."""
    runs = published_runs(spark, path).filter("n_rows > 0").select("run_date", "run_id")
    # One row per run.
    return spark.read.parquet(path).join(F.broadcast(runs), ["run_date", "run_id"], "left_semi")
