"""Category codes: fitting a mapping and applying a stored one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ordering import running_total


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """Mapping (value, code): distinct non-null values in ascending order, numbered from 0.

    The mapping is written, because every use would otherwise number the values again.
    """
    values = (
        df.select(F.col(column).alias("value"))
        .filter(F.col("value").isNotNull())
        .distinct()
        .withColumn("_one", F.lit(1).cast("bigint"))
    )
    numbered = running_total(values, ["value"], "_one", "_rank")
    return materialize(numbered.select("value", (F.col("_rank") - 1).cast("int").alias("code")))


def encode(
    df: DataFrame, mapping: DataFrame, column: str, code: str, default: int | None = None
) -> DataFrame:
    """Adds ``code``. Values outside the mapping get ``default``, or null when it is None.

    Spark broadcasts a mapping whose written size is below its broadcast threshold. A larger one is
    joined by shuffle, where adaptive execution splits the partition of a frequent value.
    """
    lookup = mapping.select(F.col("value").alias(column), F.col("code").alias(code))
    if default is None:
        return df.join(lookup, column, "left")
    return df.join(lookup, column, "left").withColumn(code, F.coalesce(F.col(code), F.lit(default)))


def label_encode(df: DataFrame, column: str, code: str) -> tuple[DataFrame, DataFrame]:
    """Encoded frame and the mapping it was encoded with."""
    mapping = fit_labels(df, column)
    return encode(df, mapping, column, code), mapping
