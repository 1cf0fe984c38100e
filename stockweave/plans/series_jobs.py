"""Training and drift of the global series forecaster."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SeriesConfig
from ..functions.bins import bin_index
from ..operators.clean import filter_if_present, prefer_value, prefer_value_totals
from ..operators.encode import encode, fit_labels
from ..operators.forecast import (
    QuantileForecaster,
    fit_forecaster,
    load_forecaster,
    save_forecaster,
    score_forecaster,
)
from ..operators.metrics import regression_metrics
from ..operators.pack import align_forecast, forecast_coverage, ordered_values, pack_series
from ..operators.quality import (
    build_constraints,
    check_constraints,
    fail_on_violation,
    quality_gate,
    statistics_report,
)
from ..operators.registry import approved_uri, register_if_passed, registry_entry
from ..operators.series import regularize, resample, resample_with_related, to_bins
from ..operators.split import median_cutoff, midpoint_cutoff, series_split
from ..session import materialize
from ..sources.mappings import read_mapping, write_mapping
from ..sources.reports import (
    evaluation_json,
    load_baseline,
    save_baseline,
    write_check,
    write_report,
)


def clean_retail(df: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """View preference, then the period filter, then totals per item and time stamp.

    The preference comes first on purpose: a row of another period can evict
    rows of the wanted one.
    """
    if cfg.view in df.columns and cfg.how != "sum":
        # An average is over the observations, not over their totals.
        kept = prefer_value(df, [cfg.item, cfg.ts], cfg.view, cfg.preferred_view)
        return filter_if_present(kept, cfg.period, cfg.period_value).select(cfg.item, cfg.ts, cfg.units)
    if cfg.view in df.columns:
        return prefer_value_totals(
            df,
            [cfg.item, cfg.ts],
            cfg.view,
            cfg.preferred_view,
            cfg.units,
            {cfg.period: cfg.period_value},
        )
    return filter_if_present(df, cfg.period, cfg.period_value).select(cfg.item, cfg.ts, cfg.units)


def regular_sales(
    retail: DataFrame, ads: DataFrame | None, cfg: SeriesConfig, ads_units: str = "ads_units"
) -> DataFrame:
    """Regular series of retail units, with the units of advertising added where given."""
    cleaned = clean_retail(retail, cfg)
    if ads is None:
        return resample(
            cleaned,
            cfg.item,
            cfg.ts,
            cfg.units,
            cfg.how,
            cfg.freq,
            interpolate=True,
            min_bins=cfg.min_bins,
        )
    if cfg.how != "sum":
        raise ValueError("advertising units can only be added to summed series")
    return resample_with_related(
        cleaned, ads, cfg.item, cfg.ts, cfg.units, ads_units, cfg.freq, cfg.min_bins
    )


def training_set(
    retail: DataFrame, ads: DataFrame | None, cfg: SeriesConfig, ads_units: str = "ads_units"
) -> tuple[DataFrame, DataFrame]:
    """Packed series ``item, start, validation_start, n_train, target, cat`` and the code mapping.

    The packed rows are written: the fit, the scoring and the evaluation read them.
    """
    parts = series_split(regular_sales(retail, ads, cfg, ads_units), cfg.train_share)
    in_validation = F.col("split") == "validation"
    grouped = parts.groupBy(cfg.item).agg(
        F.min(cfg.ts).alias("start"),
        F.min(F.when(in_validation, F.col(cfg.ts))).alias("validation_start"),
        F.count_if(~in_validation).cast("int").alias("n_train"),
        ordered_values(F.col(cfg.ts), F.col(cfg.units)).alias("target"),
    )
    packed = materialize(grouped)
    mapping = fit_labels(packed, cfg.item)
    return encode(packed, mapping, cfg.item, "cat"), mapping


def train_part(packed: DataFrame, cfg: SeriesConfig) -> DataFrame:
    target = F.slice("target", F.lit(1), F.col("n_train"))
    return packed.select(cfg.item, "start", target.alias("target"), "cat")


def validation_part(packed: DataFrame, cfg: SeriesConfig) -> DataFrame:
    target = F.slice("target", F.col("n_train") + 1, F.size("target"))
    start = F.col("validation_start").alias("start")
    return packed.select(cfg.item, start, target.alias("target"), "cat")


def context_part(train: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """Last training values, fewer for a shorter series."""
    first = F.greatest(F.size("target") - cfg.context, F.lit(0)) + 1
    return train.select(
        cfg.item, F.slice("target", first, F.lit(cfg.context)).alias("target"), "cat"
    )


@dataclass(frozen=True)
class SeriesTraining:
    model: QuantileForecaster
    mapping: DataFrame
    train: DataFrame
    validation: DataFrame
    contexts: DataFrame
    coverage: DataFrame
    metrics: DataFrame
    gate: DataFrame
    entry: DataFrame


def train_series(
    retail: DataFrame,
    ads: DataFrame | None,
    cfg: SeriesConfig,
    uri: str,
    created: str,
    group: str = "series",
    ads_units: str = "ads_units",
) -> SeriesTraining:
    """Clean, resample, encode, split, pack, fit, score the validation head, gate."""
    packed, mapping = training_set(retail, ads, cfg, ads_units)
    train, validation = train_part(packed, cfg), validation_part(packed, cfg)
    contexts = context_part(train, cfg)
    model = fit_forecaster(train, cfg.item, cfg.context, cfg.horizon, (cfg.quantile,), stride=cfg.stride, season=cfg.season)
    # One row per item, read by the coverage and by the metrics.
    forecasts = materialize(score_forecaster(model, contexts, cfg.item))
    rows = align_forecast(
        validation, forecasts, cfg.item, cfg.horizon, str(cfg.quantile), cfg.freq
    )
    # One row, read by the report, the gate and the registry.
    metrics = materialize(regression_metrics(rows, mape_scale=100.0))
    return SeriesTraining(
        model,
        mapping,
        train,
        validation,
        contexts,
        forecast_coverage(validation, forecasts, cfg.item, str(cfg.quantile)),
        metrics,
        quality_gate(metrics, "rmse", cfg.rmse_gate),
        registry_entry(metrics, group, uri, created),
    )


def publish_series(job: SeriesTraining, registry: str, reports: str) -> bool:
    """Write the evaluation; save the model with its mapping and register it if the gate passed."""
    write_report(evaluation_json(job.metrics), f"{reports}/evaluation")
    if job.gate.first()["passed"]:
        uri = job.entry.first()["uri"]
        save_forecaster(job.model, uri)
        write_mapping(job.mapping, f"{uri}/mapping")
    return register_if_passed(job.entry, job.gate, registry)


def approved_series(
    spark: SparkSession, registry: str, item_type: str, group: str = "series"
) -> tuple[QuantileForecaster, DataFrame]:
    """The newest approved model and its mapping, whose values take the items' type."""
    uri = approved_uri(spark, registry, group)
    mapping = read_mapping(spark, f"{uri}/mapping")
    return load_forecaster(spark, uri), mapping.withColumn("value", F.col("value").cast(item_type))


@dataclass(frozen=True)
class SeriesDrift:
    rows: DataFrame
    coverage: DataFrame
    metrics: DataFrame
    statistics: DataFrame
    constraints: DataFrame


def drift_set(
    observations: DataFrame, mapping: DataFrame, cfg: SeriesConfig, cutoff: str = "median"
) -> tuple[DataFrame, DataFrame]:
    """Packed contexts before a cutoff and packed truth after it, each side interpolated alone.

    ``cutoff`` is ``median`` (of all bins) or ``midpoint`` (the date at the middle
    row in item order). Items outside the mapping share the unseen code.
    """
    find = median_cutoff if cutoff == "median" else midpoint_cutoff
    cut_row = find(observations, cfg.item, cfg.ts, cfg.freq)
    # One bin number.
    found = cut_row.select(bin_index(F.col("cutoff"), cfg.freq)).first()
    if found is None or found[0] is None:
        raise ValueError("no observation to find a cutoff in")
    cut_bin = found[0]
    regular = regularize(
        to_bins(observations, cfg.item, cfg.ts, {cfg.units: "mean"}, cfg.freq),
        cfg.item,
        {cfg.units: "linear"},
        cfg.freq,
        cfg.ts,
        cut=lambda first, last: F.lit(cut_bin),
    )
    step = F.col("pos") - F.col("cut_pos")
    # Both parts are short and read several times.
    near = materialize(
        regular.withColumn("_step", step)
        .filter(F.col("_step").between(-cfg.context, cfg.horizon - 1))
        .select(cfg.item, cfg.ts, cfg.units, "_step")
    )
    contexts = pack_series(near.filter(F.col("_step") < 0), cfg.item, cfg.ts, cfg.units)
    truth = pack_series(near.filter(F.col("_step") >= 0), cfg.item, cfg.ts, cfg.units)
    return contexts, encode(truth, mapping, cfg.item, "cat", cfg.unseen_code)


def score_series_drift(
    observations: DataFrame,
    mapping: DataFrame,
    model: QuantileForecaster,
    cfg: SeriesConfig,
    cutoff: str = "median",
) -> SeriesDrift:
    """Recent series cut in two: the model sees the context before, the truth comes after.

    Items with bins on both sides are eligible; the coverage tells how many have a forecast.
    """
    contexts, truth = drift_set(observations, mapping, cfg, cutoff)
    forecasts = materialize(score_forecaster(model, contexts, cfg.item))
    eligible = truth.join(contexts.select(cfg.item), cfg.item, "left_semi")
    rows = materialize(
        align_forecast(truth, forecasts, cfg.item, cfg.horizon, str(cfg.quantile), cfg.freq)
    )
    metrics = materialize(regression_metrics(rows))
    statistics = statistics_report(metrics)
    return SeriesDrift(
        rows,
        forecast_coverage(eligible, forecasts, cfg.item, str(cfg.quantile)),
        metrics,
        statistics,
        build_constraints(statistics),
    )


def check_series_drift(
    drift: SeriesDrift,
    baseline_path: str,
    register_baseline: bool = False,
    reports: str | None = None,
) -> DataFrame:
    """Register the current metrics as baseline, or compare with the stored one and fail on a violation.

    Rejected items fail the run and register nothing. All three reports are written before it can fail.
    """
    spark = drift.metrics.sparkSession
    rejected = drift.coverage.first()["rejected"]
    if rejected and reports is None:
        raise ValueError(f"{rejected} items have no forecast")
    # A baseline is not compared with itself: it has no violation.
    baseline = drift.constraints.limit(0) if register_baseline else load_baseline(spark, baseline_path)
    violations = check_constraints(drift.statistics, baseline)
    if reports is not None:
        write_check(drift.metrics, drift.constraints, violations, reports)
    if rejected:
        raise ValueError(f"{rejected} items have no forecast")
    if register_baseline:
        save_baseline(drift.constraints, baseline_path)
    fail_on_violation(violations)
    return violations
