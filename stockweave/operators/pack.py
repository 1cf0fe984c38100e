"""Packed series (one row per item) and the rows they hold.

An array never exceeds an item's number of bins, which the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bins import bins_after
from ..functions.scalars import not_nan


def ordered_values(pos: Column, value: Column) -> Column:
    """Aggregate: values as an array in ascending position; NaN becomes null."""
    pairs = F.array_sort(F.collect_list(F.struct(pos.alias("p"), not_nan(value).alias("v"))))
    return F.transform(pairs, lambda x: x["v"])


def pack_series(
    regular: DataFrame, key: str, ts: str, value: str, cat: str | None = None
) -> DataFrame:
    """``key, start, target[, cat]`` with the values in time order."""
    aggregates = [F.min(ts).alias("start"), ordered_values(F.col(ts), F.col(value)).alias("target")]
    if cat:
        aggregates.append(F.first(cat).cast("int").alias("cat"))
    return regular.groupBy(key).agg(*aggregates)


def unpack_series(
    packed: DataFrame, key: str, ts: str = "ts", value: str = "value", freq: str = "D"
) -> DataFrame:
    """One row per array element of a packed series."""
    return packed.select(key, "start", F.posexplode("target").alias("pos", value)).select(
        key, bins_after(F.col("start"), F.col("pos"), freq).alias(ts), "pos", value
    )


def context_for_test(
    parts: DataFrame, key: str, ts: str, value: str, n: int = 28
) -> DataFrame:
    """Items with train and other rows: the last ``n`` training values and where the rest starts.

    ``parts`` is a regular frame with ``split``, whose ``pos`` and ``n_bins`` count
    within the part. Both sides come from one grouping, so the source is read
    once and no more than ``n`` values per item are collected.
    """
    in_train = F.col("split") == "train"
    in_tail = in_train & (F.col("pos") >= F.col("n_bins") - n)
    # collect_list skips the nulls outside the tail.
    slot = F.when(in_tail, F.struct(F.col(ts).alias("t"), not_nan(F.col(value)).alias("v")))
    return (
        parts.groupBy(key)
        .agg(
            F.min(F.when(in_tail, F.col(ts))).alias("context_start"),
            F.min(F.when(~in_train, F.col(ts))).alias("forecast_start"),
            F.transform(F.array_sort(F.collect_list(slot)), lambda x: x["v"]).alias("target"),
        )
        .filter(F.col("context_start").isNotNull() & F.col("forecast_start").isNotNull())
    )


def horizon_calendar(
    starts: DataFrame, start: str, horizon: int = 28, ts: str = "ts", freq: str = "D"
) -> DataFrame:
    """``horizon`` consecutive bins from each row's start."""
    step = F.explode(F.sequence(F.lit(0), F.lit(horizon - 1)))
    return starts.withColumn("step", step).withColumn(
        ts, bins_after(F.col(start), F.col("step"), freq)
    )


def align_forecast(
    actuals: DataFrame,
    forecasts: DataFrame,
    key: str,
    horizon: int = 28,
    quantile: str = "0.5",
    freq: str = "D",
) -> DataFrame:
    """Rows (key, start, target, cat, predictions) of packed actuals and forecast records.

    Actuals are cut to the horizon and predictions to the actuals' length; each
    item is paired with its own forecast and dated from its own start.
    """
    series = actuals.select(
        key, "start", F.slice("target", 1, horizon).alias("target"), *_optional(actuals, "cat")
    )
    predicted = forecasts.select(
        key, F.try_element_at("quantiles", F.lit(quantile)).alias("predictions")
    )
    paired = series.join(predicted, key).withColumn(
        "predictions", F.slice("predictions", 1, F.size("target"))
    )
    rows = paired.select(
        key,
        "start",
        *_optional(paired, "cat"),
        F.posexplode(F.arrays_zip("target", "predictions")).alias("step", "_pair"),
    )
    return rows.select(
        key,
        bins_after(F.col("start"), F.col("step"), freq).alias("start"),
        F.col("_pair.target").alias("target"),
        *_optional(rows, "cat"),
        F.col("_pair.predictions").alias("predictions"),
    )


def forecast_coverage(
    actuals: DataFrame, forecasts: DataFrame, key: str, quantile: str = "0.5"
) -> DataFrame:
    """One row (eligible, scored, rejected): items with actuals, those with a path, those without."""
    path = F.try_element_at("quantiles", F.lit(quantile))
    answered = forecasts.select(key, path.isNotNull().alias("_scored"))
    scored = F.coalesce(F.col("_scored"), F.lit(False))
    return (
        actuals.select(key)
        .join(answered, key, "left")
        .agg(
            F.count(F.lit(1)).alias("eligible"),
            F.count_if(scored).alias("scored"),
            F.count_if(~scored).alias("rejected"),
        )
    )


def _optional(df: DataFrame, column: str) -> list[str]:
    return [column] if column in df.columns else []
