"""Projection, filtering and casting of raw observation tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import calendar_parts, not_nan, recode
from ..session import materialize
from .skew import MIN_SLICE_ROWS, slice_hot_keys


def select_features(df: DataFrame, target: str, features: Iterable[str]) -> DataFrame:
    """Target first, then the features in the given order; nothing else."""
    return df.select(target, *features)


def rename_optional(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; absent ones are ignored."""
    return df.withColumnsRenamed(dict(names))


def parse_utc(df: DataFrame, column: str, lenient: bool = False) -> DataFrame:
    """Text to timestamp in the UTC session. Malformed text raises, or gives null when lenient."""
    parse = F.try_to_timestamp if lenient else F.to_timestamp
    return df.withColumn(column, parse(F.col(column)))


def filter_if_present(df: DataFrame, column: str, value: str) -> DataFrame:
    """Equality filter when the column exists, otherwise the frame as it is."""
    return df.filter(F.col(column) == value) if column in df.columns else df


def _present(keys: Iterable[str]) -> Column:
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).isNotNull()
    return test


def prefer_value(
    df: DataFrame,
    keys: list[str],
    column: str,
    preferred: str,
    min_slice: int = MIN_SLICE_ROWS,
) -> DataFrame:
    """Per key: keep every row if there is one distinct view, else only the preferred view's rows.

    Null is a view of its own; rows with a null key drop out. What goes is other
    views' rows of keys with several views, so those keys are counted map-side,
    written, and anti-joined; the rows of a very frequent key are spread over
    many join tasks.
    """
    rows = df.filter(_present(keys))
    mixed = materialize(
        rows.groupBy(*keys, column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_views"), F.sum("_n").alias("_n"))
        .filter(F.col("_views") > 1)
        .drop("_views")
    )
    left, right, on = slice_hot_keys(rows, mixed, keys, "_n", min_slice)
    left, right = left.alias("l"), right.alias("r")
    drops = ~F.equal_null(F.col(f"l.{column}"), F.lit(preferred))
    for name in on:
        drops = drops & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    return left.join(right, drops, "left_anti").select(*df.columns)


def prefer_value_totals(
    df: DataFrame,
    keys: list[str],
    column: str,
    preferred: str,
    units: str,
    then: Mapping[str, str] | None = None,
) -> DataFrame:
    """``prefer_value`` followed by equality filters and a sum of units per key.

    The choice depends only on which views a key has, so raw rows are first
    summed per key and view, map-side, and groups of raw rows never travel. Each
    filter in ``then`` applies after the choice: a row it rejects can still evict
    others.
    """
    kept = F.lit(True)
    for name, value in (then or {}).items():
        if name in df.columns:
            kept = kept & F.coalesce(F.col(name) == value, F.lit(False))
    # Null marks a key and view without any kept row; a kept null counts as 0.
    total = F.sum(F.when(kept, F.coalesce(not_nan(F.col(units)), F.lit(0.0))))
    is_preferred = F.equal_null(F.col(column), F.lit(preferred))
    return (
        df.filter(_present(keys))
        .groupBy(*keys, column)
        .agg(total.alias("_total"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_views"),
            F.sum("_total").alias("_all"),
            F.sum(F.when(is_preferred, F.col("_total"))).alias("_preferred"),
        )
        .select(
            *keys,
            F.when(F.col("_views") == 1, F.col("_all")).otherwise(F.col("_preferred")).alias(units),
        )
        .filter(F.col(units).isNotNull())
    )


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, including ones projected away later."""
    return df.dropna("any", subset=subset)


def share_above(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows above the limit, all rows and their ratio, as one row. NaN is not above."""
    above = F.count_if((F.col(column) > limit) & ~F.isnan(F.col(column).cast("double")))
    return df.agg(above.alias("n_above"), F.count(F.lit(1)).alias("n_rows")).withColumn(
        "share", F.try_divide(F.col("n_above").cast("double"), F.col("n_rows"))
    )


def outlier_gate(df: DataFrame, column: str, limit: float, max_share: float) -> DataFrame:
    """If fewer than ``max_share`` of the rows exceed the limit, keep rows strictly below it.

    Otherwise the frame is unchanged. The decision is one scalar subquery, so
    the second pass is a plain filter without a shuffle.
    """
    trim = (
        share_above(df, column, limit)
        .select(F.col("n_above") < F.lit(max_share).cast("double") * F.col("n_rows"))
        .scalar()
    )
    return df.filter(~trim | (F.col(column) < limit))


def cutoff_split(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    """Adds ``split``: train before the cutoff, test from the cutoff on."""
    before = F.col(ts) < F.lit(cutoff).cast("timestamp")
    return df.withColumn("split", F.when(before, "train").otherwise("test"))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts that raise on bad input (ANSI)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def calendar_features(df: DataFrame, date: str) -> DataFrame:
    """Replace the date by year, weekday (Monday = 0), day and month."""
    return df.withColumns(calendar_parts(F.col(date))).drop(date)


def recode_values(df: DataFrame, column: str, codes: Mapping[str, int]) -> DataFrame:
    return df.withColumn(column, recode(F.col(column), dict(codes)))
