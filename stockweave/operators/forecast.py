"""Forecasts of regular series: statistical candidates, their backtest, a global quantile model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.bins import SUB_DAILY_SECONDS, bins_after
from ..session import materialize, spread
from .metrics import forecast_metrics
from .pack import ordered_values, pack_series
from .registry import top_model
from .window_tree import INPUTS as FEATURES
from .window_tree import Windows, grow_window_tree, inner_nodes, label_rows, leaf_levels, leaf_of


def hold_out(horizon: int):
    """Cut for ``regularize``: the last ``horizon`` bins of every item are held out."""
    return lambda first, last: last - horizon + 1


def _is_train() -> Column:
    return F.col("pos") < F.col("cut_pos")


def smoothing_level(value: Column, alpha: float, cut: Column | None = None) -> Column:
    """Aggregate: exponential smoothing level after the last training bin.

    The recursion starts at the first bin with a value. It is a weighted sum, so it
    needs no order and combines map-side: every value weighs alpha * decay, the first
    one the rest of its decay as well.
    """
    cut = F.col("cut_pos") if cut is None else cut
    known = (F.col("pos") < cut) & value.isNotNull()
    decay = lambda pos: F.pow(F.lit(1.0 - alpha), cut - 1 - pos)
    all_values = F.sum(F.when(known, F.lit(alpha) * decay(F.col("pos")) * value))
    first_value = F.min_by(F.when(known, decay(F.col("pos")) * value), F.when(known, F.col("pos")))
    return all_values + F.lit(1.0 - alpha) * first_value


def history(
    regular: DataFrame,
    key: str,
    ts: str,
    value: str,
    context: int = 28,
    horizon: int = 28,
    season: int = 7,
    alpha: float = 0.3,
) -> DataFrame:
    """One row per item with all that the statistical forecasts and their scoring need.

    ``regular`` comes from ``regularize`` with a cut. The rows are already
    partitioned by item, so the lag and this grouping add no shuffle, and the
    arrays are bounded by the context and the horizon.
    """
    rows = regular.withColumn("_earlier", F.lag(value, season).over(Window.partitionBy(key).orderBy("pos")))
    state = item_state(F.col(value), F.col("_earlier"), F.col("cut_pos"), ts, context, horizon, alpha)
    return rows.groupBy(key).agg(*[c.alias(name) for name, c in state.items()])


def item_state(
    value: Column, earlier: Column, cut: Column, ts: str, context: int, horizon: int, alpha: float
) -> dict[str, Column]:
    """Aggregates per item for one cut; ``earlier`` is the value one season before."""
    train = F.col("pos") < cut
    in_context = train & (F.col("pos") >= cut - context)
    in_horizon = ~train & (F.col("pos") < cut + horizon)
    # collect_list skips nulls, so rows outside a part leave no entry.
    slot = F.struct(F.col("pos").alias("p"), value.alias("v"))
    values = lambda keep: F.transform(
        F.array_sort(F.collect_list(F.when(keep, slot))), lambda x: x["v"]
    )
    return {
        "forecast_start": F.min(F.when(~train, F.col(ts))),
        "n_train": F.greatest(F.max(cut), F.lit(0)),
        "context": values(in_context),
        "actual": values(in_horizon),
        "level": smoothing_level(value, alpha, cut),
        "scale": F.avg(F.when(train, F.abs(value - earlier))),
    }


def _flat(value: Column, horizon: int) -> Column:
    return F.array_repeat(value, horizon)


def seasonal_naive(horizon: int, season: int = 7) -> Column:
    """Path that repeats the last season of ``context``; null for shorter series."""
    recent = F.slice("context", F.size("context") - season + 1, season)
    path = F.transform(
        F.sequence(F.lit(0), F.lit(horizon - 1)),
        lambda i: F.element_at(recent, (F.pmod(i, F.lit(season)) + 1).cast("int")),
    )
    return F.when(F.size("context") >= season, path)


def weighted_history(horizon: int, quantile: float = 0.5, decay: float = 0.1) -> Column:
    """Flat path at the empirical quantile of ``context``, weights falling as exp(-decay * age).

    The answer is the first value, in ascending order, at which the cumulative
    weight reaches the quantile's share of the total.
    """
    n = F.size("context")
    # Equal values are ordered by position so the cumulative sum is reproducible.
    weighted = F.array_sort(
        F.filter(
            F.transform(
                "context",
                lambda v, i: F.struct(
                    v.alias("v"), i.alias("i"), F.exp((i - n + 1) * F.lit(float(decay))).alias("w")
                ),
            ),
            lambda x: x["v"].isNotNull(),
        )
    )
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x["w"])
    start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("hit"))

    def step(acc: Column, x: Column) -> Column:
        cum = acc["cum"] + x["w"]
        reached = cum >= F.lit(float(quantile)) * total
        return F.struct(
            cum.alias("cum"),
            F.coalesce(acc["hit"], F.when(reached, x["v"])).alias("hit"),
        )

    return F.when(n > 0, _flat(F.aggregate(weighted, start, step, lambda s: s["hit"]), horizon))


def smoothing(horizon: int) -> Column:
    """Flat path at the smoothing level."""
    return F.when(F.col("level").isNotNull(), _flat(F.col("level"), horizon))


def candidates(horizon: int, season: int = 7) -> dict[str, Column]:
    return {
        "seasonal_naive": seasonal_naive(horizon, season),
        "smoothing": smoothing(horizon),
        "weighted_history": weighted_history(horizon),
    }


def forecast_rows(
    hist: DataFrame, key: str, models: Mapping[str, Column], ts: str = "ts", freq: str = "D"
) -> DataFrame:
    """Rows (key, model, step, ts, prediction) for every candidate path; no shuffle."""
    paths = F.array(
        *[F.struct(F.lit(name).alias("model"), path.alias("path")) for name, path in models.items()]
    )
    return (
        hist.select(key, "forecast_start", F.inline(paths).alias("model", "path"))
        .select(key, "forecast_start", "model", F.posexplode("path").alias("step", "prediction"))
        .select(
            key,
            "model",
            (F.col("step") + 1).alias("step"),
            bins_after(F.col("forecast_start"), F.col("step"), freq).alias(ts),
            "prediction",
        )
    )


def backtest_rows(hist: DataFrame, key: str | Sequence[str], models: Mapping[str, Column]) -> DataFrame:
    """Each candidate's path beside the held-out actuals, one row per item, model and step.

    ``key`` names the columns of one backtest: the item, or the item and its window.

    A step that some candidate leaves open is open for all of them, so their scores cover the same rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = {name: f"_path{i}" for i, name in enumerate(models)}

    def shared(own: str) -> Column:
        filled = lambda j: reduce(and_, [F.get(c, j).isNotNull() for c in names.values()])
        return F.transform(own, lambda x, j: F.when(filled(j), x))

    paths = F.array(
        *[F.struct(F.lit(name).alias("model"), shared(c).alias("path")) for name, c in names.items()]
    )
    return (
        hist.select(*keys, "actual", "scale", *[path.alias(names[name]) for name, path in models.items()])
        .select(*keys, "actual", "scale", F.inline(paths).alias("model", "path"))
        .select(
            *keys,
            "scale",
            "model",
            F.explode(
                F.arrays_zip(F.col("actual"), F.slice("path", 1, F.size("actual")).alias("path"))
            ).alias("_r"),
        )
        .select(
            *keys,
            "model",
            "scale",
            F.col("_r.actual").alias("target"),
            F.col("_r.path").alias("predictions"),
        )
    )


def auto_forecast(
    hist: DataFrame, key: str, models: Mapping[str, Column], metric: str = "wape"
) -> tuple[DataFrame, DataFrame]:
    """Backtest metrics per candidate, and the row of the best one."""
    scores = forecast_metrics(backtest_rows(hist, key, models), by=["model"])
    return scores, top_model(scores, metric)


def pack_forecasts(rows: DataFrame, key: str, quantile: str = "0.5") -> DataFrame:
    """Forecast records: per item a map from quantile to the path, and no error."""
    path = ordered_values(F.col("step"), F.col("prediction"))
    return rows.groupBy(key).agg(
        F.create_map(F.lit(quantile), path).alias("quantiles"),
        F.lit(None).cast("string").alias("error"),
    )


# --- one model over all items -------------------------------------------------

MIN_ROWS = 20


@dataclass(frozen=True)
class QuantileForecaster:
    """A regression tree whose leaves answer any fitted quantile of the scaled target.

    ``tree`` holds (node, input, threshold) of the nodes that split; node n has the children 2n and 2n + 1.
    """

    tree: tuple[tuple[int, str, float], ...]
    leaf_quantiles: DataFrame
    quantiles: tuple[float, ...]
    context: int
    horizon: int
    season: int = 7


def _known(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def _mean(values: Column) -> Column:
    """Mean of the known values; null if there is none."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return F.try_divide(total, F.size(_known(values)))


def _context(end: Column, context: int) -> Column:
    """The ``context`` values of ``target`` up to ``end``, led by nulls where the item is younger."""
    have = F.least(end, F.lit(context))
    missing = F.array_repeat(F.lit(None).cast("double"), F.lit(context) - have)
    return F.concat(missing, F.slice("target", end - have + 1, have))


def _window(ctx: Column, season: int, *more: Column) -> Column:
    """One context window with its means, computed once per window and not once per step."""
    week = F.slice(ctx, F.size(ctx) - season + 1, season)
    return F.struct(
        ctx.alias("ctx"),
        _mean(F.transform(ctx, F.abs)).alias("mean"),
        _mean(week).alias("week_mean"),
        (F.size(_known(ctx)) / F.size(ctx)).alias("known"),
        *more,
    )


def _features(context: int, season: int) -> dict[str, Column]:
    """Scaled inputs from a window's columns and ``step``, which counts from 1.

    A bin without a value takes the window's mean; ``known`` tells how much of the window has one.
    """
    phase = F.pmod(F.col("step") - 1, F.lit(season))
    scale = F.when(F.col("mean") > 0, F.col("mean")).otherwise(1.0)
    typical = F.coalesce(_mean(F.col("ctx")), F.lit(0.0))
    scaled = lambda c: F.coalesce(c, typical) / scale
    at = lambda back: F.element_at("ctx", (context - back + 1 + phase).cast("int"))
    return {
        "scale": scale,
        "week_1": scaled(at(season)),
        "week_2": scaled(at(2 * season)),
        "recent_mean": scaled(F.col("week_mean")),
        "last_value": scaled(F.element_at("ctx", -1)),
    }


LEVEL = "item_level"
CHUNK = 64


def _sum_of(values: Column) -> Column:
    """Sum of the known values of an array."""
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))


def _chunk_totals(values: Column) -> Column:
    """Sums of all values in front of each chunk of CHUNK values: a running sum at any place is then short."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size(values) / CHUNK).cast("int")), lambda c: _sum_of(F.slice(values, c * CHUNK + 1, F.lit(CHUNK))))
    return F.transform(F.sequence(F.lit(0), F.size(chunks) - 1), lambda c: _sum_of(F.slice(chunks, F.lit(1), c)))


def _upto(totals: str, values: Column, end: Column) -> Column:
    """Sum of the first ``end`` values."""
    chunk = F.floor(end / CHUNK).cast("int")
    return F.get(totals, chunk) + _sum_of(F.slice(values, chunk * CHUNK + 1, end - chunk * CHUNK))


def _counted(values: Column) -> Column:
    return F.transform(values, lambda x: x.isNotNull().cast("double"))


def _with_totals(packed: DataFrame) -> DataFrame:
    return packed.withColumn("_ones", _counted(F.col("target"))).withColumns(
        {"_sums": _chunk_totals(F.col("target")), "_counts": _chunk_totals(F.col("_ones"))}
    )


def _levels(rows: DataFrame, packed: DataFrame, prior: float, freq: str) -> DataFrame:
    """``rows`` with ``level``, from their start, end, ``_s`` and ``_n`` (sum and number of the item's values so far).

    An item's mean so far is drawn towards the mean of all items so far, as if ``prior`` values had that mean. The
    calendar bounds the table of totals, one row per bin; unless bins are shorter than a day it is broadcast, so the
    rows are not shuffled for it.
    """
    bins = packed.select("start", F.posexplode("target").alias("_i", "_x")).groupBy(bins_after(F.col("start"), F.col("_i"), freq).alias("_last"))
    so_far = Window.orderBy("_last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = bins.agg(F.sum("_x").alias("_x"), F.count("_x").alias("_k")).select(
        "_last", F.coalesce(F.try_divide(F.sum("_x").over(so_far), F.sum("_k").over(so_far)), F.lit(0.0)).alias("_all")
    )
    level = (F.col("_s") + F.lit(float(prior)) * F.col("_all")) / (F.col("_n") + F.lit(float(prior)))
    if freq not in SUB_DAILY_SECONDS:
        totals = F.broadcast(totals)
    return rows.withColumn("_last", bins_after(F.col("start"), F.col("end") - 1, freq)).join(totals, "_last").withColumn("level", level).drop("_s", "_n", "_all")


def item_levels(packed: DataFrame, key: str, prior: float = 10.0, freq: str = "D") -> DataFrame:
    """(key, end, last bin, level) after each bin: what is known of an item's code by then, and of no later value."""
    so_far = Window.partitionBy(key).orderBy("end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A packed row is small, its bins are not: rows are spread first, and the running sums follow that partitioning.
    bins = spread(packed.select(key, "start", "target"), key).select(key, "start", F.posexplode("target").alias("_i", "_v"))
    rows = bins.select(key, "start", (F.col("_i") + 1).alias("end"), "_v").select(
        key, "start", "end", F.coalesce(F.sum("_v").over(so_far), F.lit(0.0)).alias("_s"), F.count("_v").over(so_far).cast("double").alias("_n")
    )
    return _levels(rows, packed, prior, freq).select(key, "end", F.col("_last").alias("last"), "level")


def training_rows(
    packed: DataFrame,
    key: str,
    context: int = 28,
    horizon: int = 28,
    stride: int = 1,
    season: int = 7,
    prior: float | None = None,
    freq: str = "D",
) -> DataFrame:
    """Context windows every ``stride`` bins with each of the following ``horizon`` values.

    An item too short for a whole window and horizon gives one window of its first half
    (the context at most), whose future is the rest, so every item of two bins or more teaches.
    Windows lie inside the packed training part, so none crosses the cut. A value
    becomes about ``horizon / stride`` rows, so the packed rows are spread first.
    With ``prior`` the rows have ``item_level``, the scaled level of ``item_levels`` at the window's end.
    """
    n = F.size("target")
    if prior is None:
        items = packed.filter(n >= 2).select(key, F.col("target").cast("array<double>").alias("target"))
        return label_rows(spread(items, key), key, Windows(context, horizon, stride, season))
    first = F.least(F.lit(context), F.ceil(n / 2).cast("int"))
    windows = F.transform(
        F.sequence(first, F.greatest(n - horizon, first), F.lit(stride)),
        lambda end: _window(
            _context(end, context),
            season,
            F.slice("target", end + 1, horizon).alias("future"),
            end.alias("end"),
            _upto("_sums", F.col("target"), end).alias("_s"),
            _upto("_counts", F.col("_ones"), end).alias("_n"),
        ),
    )
    items = spread(packed.filter(n >= 2).select(key, "start", "target"), key)
    wide = _levels(_with_totals(items).select(key, "start", F.inline(windows)), packed, prior, freq)
    return (
        wide.select(key, "ctx", "mean", "week_mean", "known", "level", F.posexplode("future").alias("_i", "_y"))
        .filter(F.col("_y").isNotNull())
        .withColumn("step", F.col("_i") + 1)
        .withColumns(_features(context, season))
        .withColumn(LEVEL, F.col("level") / F.col("scale"))
        .select(key, *FEATURES, LEVEL, (F.col("_y") / F.col("scale")).alias("label"))
    )


def fit_forecaster(
    packed: DataFrame,
    key: str,
    context: int = 28,
    horizon: int = 28,
    quantiles: Sequence[float] = (0.5,),
    max_depth: int = 6,
    seed: int = 1729,
    stride: int = 1,
    season: int = 7,
) -> QuantileForecaster:
    """Fit the tree on the ``training_rows`` of all items; leaf quantiles are counted, one row per leaf.

    The rows are made anew in each pass over the packed series (``window_tree``), never stored.

    Absolute-loss boosting would need many rounds and answer one quantile; leaf
    quantiles of one tree answer any (Meinshausen 2006).
    """
    # Packed rows are small, their windows are not: they are spread and written once for all passes.
    series = materialize(spread(packed.filter(F.size("target") >= 2).select(key, "target"), key).select("target"))
    tree, binning = grow_window_tree(series, Windows(context, horizon, stride, season), max_depth, MIN_ROWS, seed)
    levels = leaf_levels(series, tree, binning, [float(q) for q in quantiles])
    leaf_quantiles = materialize(packed.sparkSession.createDataFrame(levels, "leaf int, levels array<double>").coalesce(1))
    return QuantileForecaster(tuple(inner_nodes(tree, binning)), leaf_quantiles, tuple(quantiles), context, horizon, season)


def score_forecaster(
    model: QuantileForecaster, contexts: DataFrame, key: str
) -> DataFrame:
    """Forecast records (key, quantiles map, error) for packed contexts, of which the last values count.

    A short context is scored with its missing bins marked. One without any value
    yields an ``error`` record.
    """
    steps, empty = scoring_steps(contexts, key, model.context, model.horizon, model.season)
    # The tree has at most 2^max_depth leaves.
    scored = steps.select(key, "step", "scale", leaf_of(list(model.tree)).alias("leaf")).join(
        F.broadcast(model.leaf_quantiles), "leaf"
    )
    return forecast_records(scored, key, model.quantiles).unionByName(empty)


def scoring_steps(
    contexts: DataFrame, key: str, context: int, horizon: int, season: int, *more: str
) -> tuple[DataFrame, DataFrame]:
    """Inputs of every step to forecast, and ``error`` records of contexts without any value.

    Columns named in ``more`` are kept beside the inputs.
    """
    windows = contexts.select(key, *more, _context(F.size("target"), context).alias("ctx"))
    usable = F.coalesce(F.exists("ctx", lambda x: x.isNotNull()), F.lit(False))
    steps = (
        windows.filter(usable)
        .select(key, *more, F.inline(F.array(_window(F.col("ctx"), season))))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
        .withColumns(_features(context, season))
    )
    empty = windows.filter(~usable).select(
        key,
        F.lit(None).cast("map<string,array<double>>").alias("quantiles"),
        F.lit("context without any value").alias("error"),
    )
    return steps, empty


def forecast_records(scored: DataFrame, key: str, quantiles: Sequence[float]) -> DataFrame:
    """One record per item from its steps' scaled ``levels``, one level per quantile."""
    paths = scored.groupBy(key).agg(
        *[
            ordered_values(F.col("step"), F.col("levels")[i] * F.col("scale")).alias(f"_q{i}")
            for i in range(len(quantiles))
        ]
    )
    pairs = [x for i, q in enumerate(quantiles) for x in (F.lit(str(q)), F.col(f"_q{i}"))]
    return paths.select(
        key, F.create_map(*pairs).alias("quantiles"), F.lit(None).cast("string").alias("error")
    )


def with_global_path(
    hist: DataFrame, regular: DataFrame, key: str, ts: str, value: str, context: int = 28, horizon: int = 28, season: int = 7
) -> tuple[DataFrame, QuantileForecaster]:
    """``hist`` with ``global_path``, the median path of one model fitted on all training bins of ``regular``.

    Only bins before the cut are packed, so the held-out ones teach nothing; a context
    without any value has a null path.
    """
    packed = materialize(pack_series(regular.filter(_is_train()), key, ts, value))
    model = fit_forecaster(packed, key, context, horizon, season=season)
    median = F.element_at("quantiles", str(model.quantiles[0])).alias("global_path")
    return hist.join(score_forecaster(model, packed, key).select(key, median), key, "left"), model


_NODES = "node int, input string, threshold double"
_SETTINGS = "quantiles array<double>, context int, horizon int, season int"


def save_forecaster(model: QuantileForecaster, path: str) -> None:
    """The tree, its leaves and its settings below ``path``."""
    spark = model.leaf_quantiles.sparkSession
    spark.createDataFrame(list(model.tree), _NODES).write.mode("overwrite").parquet(f"{path}/tree")
    model.leaf_quantiles.write.mode("overwrite").parquet(f"{path}/leaves")
    row = ([float(q) for q in model.quantiles], model.context, model.horizon, model.season)
    spark.createDataFrame([row], _SETTINGS).write.mode("overwrite").json(f"{path}/settings")


def load_forecaster(spark: SparkSession, path: str) -> QuantileForecaster:
    settings = spark.read.schema(_SETTINGS).json(f"{path}/settings").first()
    return QuantileForecaster(
        tuple(tuple(r) for r in spark.read.schema(_NODES).parquet(f"{path}/tree").orderBy("node").collect()),
        spark.read.parquet(f"{path}/leaves"),
        tuple(settings["quantiles"]),
        settings["context"],
        settings["horizon"],
        settings["season"],
    )
