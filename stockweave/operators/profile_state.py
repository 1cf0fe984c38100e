"""Profiles that merge: sums and sketches per column, from which a baseline grows without reading old rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import not_nan
from .profile import DECILES

# 2**12 registers: distinct counts are off by about 1.6 % (one standard error).
DISTINCT_BITS = 12
# Quantile sketch: ranks are off by about 0.2 % of the rows, in some 50 kB per column.
QUANTILE_K = 2_000


def _state(df: DataFrame, column: str) -> Column:
    """Aggregate struct of one column; every column has the same fields."""
    c, kind = F.col(column), df.schema[column].dataType
    numeric = isinstance(kind, T.NumericType)
    x = not_nan(c.cast("double")) if numeric else F.lit(None).cast("double")
    c = F.when(x.isNotNull(), c) if numeric else c  # NaN is missing
    # One hash for both zeros.
    mark = c + F.lit(0.0) if isinstance(kind, (T.DoubleType, T.FloatType)) else c
    mark = F.when(c.isNotNull(), F.xxhash64(mark.cast("string") if isinstance(kind, T.MapType) else mark))
    quantiles = F.kll_sketch_agg_double(x, F.lit(QUANTILE_K)) if numeric else F.lit(None).cast("binary")
    return F.struct(
        F.lit(column).alias("column"),
        F.lit(kind.simpleString()).alias("data_type"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(c).alias("n_present"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.sum(x).alias("sum"),
        (F.var_pop(x) * F.count(x)).alias("squares"),
        F.hll_sketch_agg(mark, F.lit(DISTINCT_BITS)).alias("distinct"),
        quantiles.alias("quantiles"),
    )


def profile_state(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per column, and per value of ``by``: counts, sums and sketches of bounded size, in one pass.

    ``squares`` is the sum of squared distances from the mean, so that merging loses no digits.
    """
    columns = [c for c in (columns or df.columns) if c not in by]
    states = df.groupBy(*by).agg(F.array(*[_state(df, c) for c in columns]).alias("_s"))
    return states.select(*by, F.inline("_s"))


def merge_states(states: DataFrame) -> DataFrame:
    """One state per column from those of many parts; the result merges again.

    A column that some parts lack counts the rows of the others only. Types that differ between parts are
    listed, so a check against the merged profile reports them.
    """
    part = Window.partitionBy("column")
    mean = F.try_divide(F.sum("sum").over(part), F.sum(F.when(F.col("sum").isNotNull(), F.col("n_present"))).over(part))
    here = F.try_divide("sum", "n_present")
    apart = F.col("squares") + F.col("n_present") * (here - mean) * (here - mean)
    return (
        states.withColumn("_apart", apart)
        .groupBy("column")
        .agg(
            F.array_join(F.array_sort(F.collect_set("data_type")), ", ").alias("data_type"),
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_present").alias("n_present"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.sum("sum").alias("sum"),
            F.sum("_apart").alias("squares"),
            F.hll_union_agg("distinct").alias("distinct"),
            F.kll_merge_agg_double("quantiles").alias("quantiles"),
        )
    )


def profile_of(state: DataFrame) -> DataFrame:
    """The state as a profile, with the columns of ``column_profile``: a baseline of checks and distances."""
    n = F.col("n_present")
    known = F.col("sum").isNotNull()
    at = F.array(*[F.lit(p) for p in DECILES])
    return state.select(
        "column",
        "data_type",
        "n_rows",
        "n_present",
        F.try_divide(n.cast("double"), F.col("n_rows")).alias("completeness"),
        F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0)).alias("n_distinct"),
        "min",
        "max",
        "sum",
        F.try_divide("sum", n).alias("mean"),
        F.sqrt(F.try_divide("squares", n)).alias("std"),
        (F.col("min") >= 0).alias("non_negative"),
        F.when(known, F.kll_sketch_get_quantile_double("quantiles", at)).alias("deciles"),
    )
