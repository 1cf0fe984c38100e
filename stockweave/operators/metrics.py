"""Regression and forecast metrics, each in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: added to the actual in the percentage error.
MAPE_EPSILON = 0.001


def regression_metrics(
    df: DataFrame,
    actual: str = "target",
    predicted: str = "predictions",
    by: Sequence[str] = (),
    mape_scale: float = 1.0,
) -> DataFrame:
    """item_count, mse, rmse, std (population, of residuals), mape and r2.

    Rows without actual or prediction are not scored. Constant actuals give r2
    1.0 for no error and 0.0 otherwise; fewer than two rows give null.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = F.col("_e")
    scored = df.select(*by, y.alias("_y"), (y - p).alias("_e")).filter(e.isNotNull())
    sums = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.avg(e * e).alias("mse"),
        F.stddev_pop(e).alias("std"),
        (
            F.avg(F.abs(F.try_divide(e, F.col("_y") + F.lit(MAPE_EPSILON)))) * F.lit(mape_scale)
        ).alias("mape"),
        F.var_pop("_y").alias("_var"),
        (F.min("_y") == F.max("_y")).alias("_constant"),
    )
    r2 = (
        F.when(F.col("item_count") < 2, F.lit(None).cast("double"))
        .when(F.col("_constant"), F.when(F.col("mse") == 0, 1.0).otherwise(0.0))
        .otherwise(1.0 - F.try_divide(F.col("mse"), F.col("_var")))
    )
    return sums.select(
        *by, "item_count", "mse", F.sqrt("mse").alias("rmse"), "std", "mape", r2.alias("r2")
    )


def seasonal_scale(regular: DataFrame, key: str, value: str, season: int = 7) -> DataFrame:
    """Per item: mean absolute difference to the value one season earlier."""
    earlier = F.lag(value, season).over(Window.partitionBy(key).orderBy("pos"))
    return (
        regular.withColumn("_d", F.abs(F.col(value) - earlier))
        .groupBy(key)
        .agg(F.avg("_d").alias("scale"))
    )


def forecast_metrics(
    df: DataFrame,
    actual: str = "target",
    predicted: str = "predictions",
    scale: str = "scale",
    by: Sequence[str] = (),
) -> DataFrame:
    """wape, rmse, mase, mape, the zero share of the actuals and the rows scored.

    ``scale`` holds each row's in-sample seasonal-naive error (Hyndman and
    Koehler 2006). Ratios over zero are left out of their mean.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = F.col("_e")
    scored = df.select(
        *by, y.alias("_y"), (y - p).alias("_e"), F.col(scale).alias("_scale")
    ).filter(e.isNotNull())
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.try_divide(F.sum(F.abs(e)), F.sum(F.abs("_y"))).alias("wape"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.try_divide(F.abs(e), F.col("_scale"))).alias("mase"),
        F.avg(F.abs(F.try_divide(e, F.col("_y")))).alias("mape"),
        F.avg((F.col("_y") == 0).cast("double")).alias("zero_share"),
    )
