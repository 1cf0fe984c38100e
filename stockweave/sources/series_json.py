"""JSON lines: packed series and forecast records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ts_text

SERIES_SCHEMA = "start string, target array<double>, cat int"
FORECAST_SCHEMA = "cat int, quantiles map<string,array<double>>, error string"


def write_series_json(packed: DataFrame, path: str) -> None:
    """One object per line with start, target and cat in this order."""
    start = packed.schema["start"].dataType.simpleString()
    text = F.col("start") if start == "string" else ts_text(F.col("start"))
    columns = [text.alias("start"), F.col("target")]
    if "cat" in packed.columns:
        columns.append(F.col("cat"))
    # A missing value inside a target stays in its place as null.
    packed.select(*columns).write.mode("overwrite").json(path)


def read_series_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERIES_SCHEMA).json(path)


def write_forecasts(forecasts: DataFrame, path: str) -> None:
    columns = [c for c in ("cat", "quantiles", "error") if c in forecasts.columns]
    forecasts.select(*columns).write.mode("overwrite").json(path)


def read_forecasts(
    spark: SparkSession, path: str, quantile: str = "0.5", strict: bool = True
) -> DataFrame:
    """(cat, prediction) of one quantile. A record with an error raises, or drops out if not strict."""
    records = spark.read.schema(FORECAST_SCHEMA).json(path)
    failed = F.col("error").isNotNull()
    if strict:
        # In the projection, so column pruning cannot skip the check.
        path_of = F.when(failed, F.raise_error(F.col("error")).cast("array<double>")).otherwise(
            F.try_element_at("quantiles", F.lit(quantile))
        )
        return records.select("cat", path_of.alias("prediction"))
    return records.filter(~failed).select(
        "cat", F.try_element_at("quantiles", F.lit(quantile)).alias("prediction")
    )


def rejected_forecasts(spark: SparkSession, path: str) -> DataFrame:
    """The records that carry an error."""
    return spark.read.schema(FORECAST_SCHEMA).json(path).filter(F.col("error").isNotNull())
