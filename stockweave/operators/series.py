"""Irregular observations to regular series.

A regular series has the columns ``key, ts, values…, pos, n_bins``: one row per
bin between an item's own first and last bin, ``pos`` counting from 0. Because
every row knows its position and the length of its series, splits, tails and
heads are plain filters without sorting or shuffling.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import SUB_DAILY_SECONDS, bin_index, bin_label
from ..functions.scalars import not_nan
from ..session import spread

# A day grid has under 37,000 bins per item and century, which one window task
# sorts easily. Sub-daily grids are cut into chunks of this many bins.
CHUNK_BINS = 4096


def to_bins(
    df: DataFrame, key: str, ts: str, values: Mapping[str, str], freq: str = "D"
) -> DataFrame:
    """Aggregate observations per item and bin; rows without item or time drop out.

    ``values`` maps a column to ``sum`` (nulls count as 0) or ``mean`` (a bin of
    nulls stays null). Partial aggregation runs before the shuffle, so an item
    with many rows per bin arrives as at most one row per bin and map task.
    """
    aggregates = []
    for name, how in values.items():
        if how == "sum":
            aggregates.append(F.coalesce(F.sum(not_nan(F.col(name))), F.lit(0.0)).alias(name))
        elif how == "mean":
            aggregates.append(F.avg(not_nan(F.col(name))).alias(name))
        else:
            raise ValueError(f"unknown aggregate {how!r}")
    return (
        df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(key), bin_index(F.col(ts), freq).alias("bin"))
        .agg(*aggregates)
    )


def _anchor(name: str) -> Column:
    """Bin and value of an observed non-null bin, null otherwise."""
    return F.when(F.col(name).isNotNull(), F.struct(F.col("bin"), F.col(name).alias("v")))


def _next_non_null(column: str, over: str) -> Column:
    return F.expr(f"lead({column}) IGNORE NULLS OVER ({over})")


def _neighbours(bins: DataFrame, key: str, linear: list[str]) -> DataFrame:
    """Next observed bin, series bounds and the anchors around each observed bin, in one window."""
    ordered = Window.partitionBy(key).orderBy("bin")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sofar = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = bins.withColumns({f"_a_{c}": _anchor(c) for c in linear})
    columns = {
        "_next": F.lead("bin").over(ordered),
        "_first": F.first("bin").over(whole),
        "_last": F.last("bin").over(whole),
    }
    for c in linear:
        columns[f"_p_{c}"] = F.last(f"_a_{c}", ignorenulls=True).over(sofar)
        columns[f"_n_{c}"] = _next_non_null(f"_a_{c}", f"PARTITION BY `{key}` ORDER BY bin")
    return out.withColumns(columns)


def _neighbours_chunked(bins: DataFrame, key: str, linear: list[str], chunk: int) -> DataFrame:
    """Same columns as ``_neighbours`` for items with very many bins.

    Windows run per (item, chunk); what lies beyond a chunk comes from a table
    with one row per chunk, windowed per item.
    """
    bins = bins.withColumns(
        {"_chunk": F.floor(F.col("bin") / F.lit(chunk)), **{f"_a_{c}": _anchor(c) for c in linear}}
    )
    edges = [F.min("bin").alias("_lo"), F.max("bin").alias("_hi")]
    for c in linear:
        # Structs compare by their first field, the bin.
        edges += [F.min(f"_a_{c}").alias(f"_fa_{c}"), F.max(f"_a_{c}").alias(f"_la_{c}")]
    per_chunk = bins.groupBy(key, "_chunk").agg(*edges)

    order = Window.partitionBy(key).orderBy("_chunk")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "_next_lo": F.lead("_lo").over(order),
        "_first": F.first("_lo").over(whole),
        "_last": F.last("_hi").over(whole),
    }
    for c in linear:
        carried[f"_cp_{c}"] = F.last(f"_la_{c}", ignorenulls=True).over(earlier)
        carried[f"_cn_{c}"] = _next_non_null(f"_fa_{c}", f"PARTITION BY `{key}` ORDER BY _chunk")
    carry = per_chunk.withColumns(carried).select(key, "_chunk", *carried)

    inside = Window.partitionBy(key, "_chunk").orderBy("bin")
    sofar = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = f"PARTITION BY `{key}`, _chunk ORDER BY bin"
    columns = {"_next": F.coalesce(F.lead("bin").over(inside), F.col("_next_lo"))}
    for c in linear:
        columns[f"_p_{c}"] = F.coalesce(
            F.last(f"_a_{c}", ignorenulls=True).over(sofar), F.col(f"_cp_{c}")
        )
        columns[f"_n_{c}"] = F.coalesce(_next_non_null(f"_a_{c}", over), F.col(f"_cn_{c}"))
    return bins.join(carry, [key, "_chunk"]).withColumns(columns)


def _on_line(name: str, cut: Column | None) -> Column:
    """Linear value of a bin between its anchors.

    No anchor before: null. None after: the last value repeats. With a cut,
    anchors on the other side of it do not exist for this bin.
    """
    prev, nxt = F.col(f"_p_{name}"), F.col(f"_n_{name}")
    has_prev, has_next = prev.isNotNull(), nxt.isNotNull()
    if cut is not None:
        after_cut = F.col("_bin") >= cut
        has_prev = has_prev & (~after_cut | (prev["bin"] >= cut))
        has_next = has_next & (after_cut | (nxt["bin"] < cut))
    slope = (nxt["v"] - prev["v"]) / (nxt["bin"] - prev["bin"])
    return F.when(
        has_prev,
        F.when(has_next, slope * (F.col("_bin") - prev["bin"]) + prev["v"]).otherwise(prev["v"]),
    )


def regularize(
    bins: DataFrame,
    key: str,
    fill: Mapping[str, str],
    freq: str = "D",
    ts: str = "ts",
    min_bins: int = 0,
    cut: Callable[[Column, Column], Column | list[Column]] | None = None,
    chunk_bins: int | None = None,
    by_key: bool = False,
) -> DataFrame:
    """Gap-free grid from the output of ``to_bins``.

    ``fill`` maps a value column to ``zero``, ``null`` or ``linear``. Observed bins
    are widened to the bins up to the next one, so no calendar table is joined
    and the rows between two observations appear only after the shuffle.
    ``min_bins`` drops short series before they are widened. ``cut`` is given the
    first and last bin number and returns the first held-out bin: both sides are
    then interpolated on their own, and ``cut_pos`` is the cut as position. It may
    return a list of cuts: value columns and ``cut_pos`` are then arrays with one
    entry per cut, the value as that cut alone would give it, on the same one grid.

    The observed bins are spread over a fixed number of partitions by item before they are widened: merged by
    the small size of the observed bins, a task would hold a grid many times that size. ``by_key`` says
    that ``bins`` come spread like this.
    """
    linear = [c for c, how in fill.items() if how == "linear"]
    if chunk_bins is None and freq in SUB_DAILY_SECONDS:
        chunk_bins = CHUNK_BINS
    if chunk_bins:
        sparse = _neighbours_chunked(bins, key, linear, chunk_bins)
    else:
        sparse = _neighbours(bins if by_key else spread(bins, key), key, linear)
    if min_bins:
        sparse = sparse.filter(F.col("_last") - F.col("_first") + 1 >= min_bins)
    given = cut(F.col("_first"), F.col("_last")) if cut is not None else None
    several = isinstance(given, list)
    listed = given if several else [c for c in (given,) if c is not None]
    sparse = sparse.withColumns({f"_cut{i}": c.cast("bigint") for i, c in enumerate(listed)})
    cuts = [F.col(f"_cut{i}") for i in range(len(listed))]
    per_cut = lambda one: F.array(*map(one, cuts)) if several else one(cuts[0] if cuts else None)

    until = F.coalesce(F.col("_next") - 1, F.col("bin"))
    dense = sparse.withColumn("_bin", F.explode(F.sequence(F.col("bin"), until)))
    observed = F.col("_bin") == F.col("bin")
    columns = []
    for name, how in fill.items():
        if how == "linear":
            value = lambda c, name=name: _on_line(name, c)
        elif how == "zero":
            value = lambda _, name=name: F.when(observed, F.col(name)).otherwise(F.lit(0.0))
        elif how == "null":
            value = lambda _, name=name: F.when(observed, F.col(name))
        else:
            raise ValueError(f"unknown fill {how!r}")
        columns.append(per_cut(value).alias(name))
    columns += [
        (F.col("_bin") - F.col("_first")).cast("int").alias("pos"),
        (F.col("_last") - F.col("_first") + 1).cast("int").alias("n_bins"),
    ]
    if cuts:
        columns.append(per_cut(lambda c: (c - F.col("_first")).cast("int")).alias("cut_pos"))
    return dense.select(key, bin_label(F.col("_bin"), freq).alias(ts), *columns)


def resample(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    how: str = "sum",
    freq: str = "D",
    interpolate: bool = False,
    min_bins: int = 0,
) -> DataFrame:
    """One value per item and bin. Empty bins are 0 for ``sum``; null or a line for ``mean``."""
    fill = "zero" if how == "sum" else ("linear" if interpolate else "null")
    bins = to_bins(df, key, ts, {value: how}, freq)
    return regularize(bins, key, {value: fill}, freq, ts, min_bins)


def resample_with_related(
    base: DataFrame,
    other: DataFrame,
    key: str,
    ts: str,
    units: str,
    other_units: str,
    freq: str = "D",
    min_bins: int = 0,
) -> DataFrame:
    """Summed units of ``base`` plus those of ``other`` on the grid of ``base``.

    Equals resampling both sides and left-joining them on (item, bin): bins of
    ``other`` outside an item's base grid vanish, missing ones add 0. Both
    sources are stacked and summed once, so there is no join.
    """
    time = bin_index(F.col(ts), freq).alias("bin")
    amount = lambda c: F.coalesce(not_nan(F.col(c)), F.lit(0.0)).alias("_u")
    stacked = base.select(key, time, amount(units), F.lit(True).alias("_base")).unionByName(
        other.select(key, time, amount(other_units), F.lit(False).alias("_base"))
    )
    bins = (
        stacked.filter(F.col(key).isNotNull() & F.col("bin").isNotNull())
        .groupBy(key, "bin")
        .agg(F.sum("_u").alias(units), F.max("_base").alias("_base"))
    )
    base_bin = F.when(F.col("_base"), F.col("bin"))
    item = Window.partitionBy(key)
    inside = spread(bins, key).withColumns(
        {"_lo": F.min(base_bin).over(item), "_hi": F.max(base_bin).over(item)}
    ).filter(F.col("bin").between(F.col("_lo"), F.col("_hi")))
    return regularize(inside.drop("_base", "_lo", "_hi"), key, {units: "zero"}, freq, ts, min_bins, by_key=True)


def add_related(
    base: DataFrame, other: DataFrame, keys: list[str], units: str, other_units: str
) -> DataFrame:
    """Left join of two regular frames; missing related units count as 0."""
    related = other.select(*keys, F.col(other_units).alias("_related"))
    total = F.col(units) + F.coalesce(F.col("_related"), F.lit(0.0))
    return base.join(related, keys, "left").withColumn(units, total).select(*base.columns)


def min_history(regular: DataFrame, min_bins: int) -> DataFrame:
    """Items with at least ``min_bins`` bins."""
    return regular.filter(F.col("n_bins") >= min_bins)


def with_positions(df: DataFrame, key: str, ts: str, freq: str = "D") -> DataFrame:
    """Adds ``pos`` and ``n_bins`` to a gap-free frame that came from elsewhere."""
    item = Window.partitionBy(key)
    number = bin_index(F.col(ts), freq)
    return (
        df.withColumn("_bin", number)
        .withColumns({"_first": F.min("_bin").over(item), "_last": F.max("_bin").over(item)})
        .withColumns(
            {
                "pos": (F.col("_bin") - F.col("_first")).cast("int"),
                "n_bins": (F.col("_last") - F.col("_first") + 1).cast("int"),
            }
        )
        .drop("_bin", "_first", "_last")
    )


def series_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_bins"))


def series_start(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(ts).alias("start"))


def ordered_series(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Items and bins ascending; range partitions on both, so a long item spreads over several."""
    return df.repartitionByRange(key, ts).sortWithinPartitions(key, ts)


def long_enough(bins: DataFrame, key: str, min_bins: int) -> DataFrame:
    """``to_bins`` rows of items whose first and last bin span at least ``min_bins`` bins.

    The rows come spread by the key, so ``regularize`` needs no further shuffle if told so (``by_key``).
    """
    item = Window.partitionBy(key)
    span = F.max("bin").over(item) - F.min("bin").over(item) + 1
    return spread(bins, key).withColumn("_span", span).filter(F.col("_span") >= min_bins).drop("_span")
