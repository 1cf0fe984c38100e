"""Training and drift of the boosted trees on campaign rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TabularConfig
from ..functions.scalars import STATUS_CODES, TARGETING_CODES
from ..operators.boosting import BoostedTrees, TreeSettings, fit_boosted, load_boosted
from ..operators.clean import (
    calendar_features,
    cast_columns,
    drop_incomplete,
    outlier_gate,
    recode_values,
    rename_optional,
    select_features,
)
from ..operators.encode import encode, fit_labels
from ..operators.metrics import regression_metrics
from ..operators.profile import column_profile, data_check, distribution_distance
from ..operators.quality import (
    build_constraints,
    check_constraints,
    fail_on_violation,
    quality_gate,
    statistics_report,
)
from ..operators.registry import approved_uri, register_if_passed, registry_entry
from ..operators.split import number_rows, random_split
from ..operators.tabular import GAMMA, SUBSAMPLE, score, search
from ..session import materialize
from ..sources.mappings import read_mapping, write_mapping
from ..sources.reports import (
    evaluation_json,
    load_baseline,
    save_baseline,
    write_check,
    write_report,
)
from ..sources.tables import capture


def encoded_rows(
    df: DataFrame, cfg: TabularConfig, mappings: Mapping[str, DataFrame] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Calendar parts, codes, recodings; rows with any missing value drop out.

    Without stored mappings, codes are fitted on all rows before incomplete ones
    are dropped. With them, values they do not know become missing.
    """
    df = rename_optional(calendar_features(df, cfg.date), cfg.renames)
    used = dict(mappings or {})
    for column in cfg.encode:
        if column not in used:
            used[column] = fit_labels(df, column)
        df = encode(df, used[column], column, f"{column}_code").drop(column)
    df = recode_values(df, "targeting_type", TARGETING_CODES)
    df = recode_values(df, "status", STATUS_CODES)
    df = drop_incomplete(df)
    whole = {f"{c}_code": "int" for c in cfg.encode} | {"targeting_type": "int"}
    if "Cluster" in df.columns:
        whole["Cluster"] = "int"
    return cast_columns(df, whole), used


def training_rows(df: DataFrame, cfg: TabularConfig) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Target, features and ``split`` of the encoded rows, and the fitted mappings."""
    rows, mappings = encoded_rows(df, cfg)
    key = cfg.row_key
    if key is None:
        key = "_row_key"
        rows = number_rows(rows, key)
    parts = random_split(rows, key, cfg.train_percent, cfg.val_percent, cfg.seed)
    return parts.select(cfg.target, *cfg.features, "split"), mappings


def drift_rows(
    df: DataFrame, cfg: TabularConfig, mappings: Mapping[str, DataFrame]
) -> DataFrame:
    """Target and features of new rows: encoded with stored maps, outliers trimmed."""
    rows, _ = encoded_rows(df, cfg, mappings)
    # The share of outliers and the filter both read these rows.
    rows = materialize(rows)
    rows = outlier_gate(rows, cfg.outlier_column, cfg.outlier_limit, cfg.outlier_share)
    return select_features(rows, cfg.target, cfg.features)


def _pairs(scored: DataFrame, cfg: TabularConfig) -> DataFrame:
    return scored.select(F.col(cfg.target).cast("double").alias("label"), "prediction")


@dataclass(frozen=True)
class TabularTraining:
    model: BoostedTrees
    mappings: dict[str, DataFrame]
    profile: DataFrame
    trials: DataFrame | None
    pairs: DataFrame
    metrics: DataFrame
    statistics: DataFrame
    constraints: DataFrame
    gate: DataFrame
    entry: DataFrame


def train_tabular(
    df: DataFrame, cfg: TabularConfig, uri: str, created: str, group: str = "tabular"
) -> TabularTraining:
    """Encode, split, profile, search (or fit once when ``trials`` is 0), score, gate."""
    parts, mappings = training_rows(df, cfg)
    # The trials, the profile and the scoring all read these rows.
    parts = materialize(parts)
    # A weight of 8 stands for the eight copies of each training row.
    train = parts.filter("split = 'train'").withColumn("_weight", F.lit(float(cfg.oversample)))
    validation, test = parts.filter("split = 'validation'"), parts.filter("split = 'test'")
    profile = materialize(column_profile(select_features(train, cfg.target, cfg.features)))
    if cfg.trials:
        model, trials = search(
            train,
            validation,
            cfg.target,
            cfg.features,
            trials=cfg.trials,
            rounds=cfg.rounds,
            weight="_weight",
            seed=cfg.seed,
        )
    else:
        settings = TreeSettings(gamma=GAMMA, subsample=SUBSAMPLE)
        model = fit_boosted(train, cfg.target, cfg.features, [settings], cfg.rounds, "_weight", cfg.seed)[0]
        trials = None
    pairs = _pairs(score(model, test), cfg)
    # One row, read by the report, the gate and the registry.
    metrics = materialize(regression_metrics(pairs, "label", "prediction"))
    statistics = statistics_report(metrics)
    return TabularTraining(
        model,
        mappings,
        profile,
        trials,
        pairs,
        metrics,
        statistics,
        build_constraints(statistics),
        quality_gate(metrics, "rmse", cfg.rmse_gate),
        registry_entry(metrics, group, uri, created),
    )


def publish_tabular(job: TabularTraining, registry: str, reports: str) -> bool:
    """Write the evaluation; save model, mappings and baselines and register it if the gate passed."""
    write_report(evaluation_json(job.metrics), f"{reports}/evaluation")
    if job.gate.first()["passed"]:
        uri = job.entry.first()["uri"]
        job.model.save(job.metrics.sparkSession, f"{uri}/model")
        job.profile.write.mode("overwrite").parquet(f"{uri}/profile")
        save_baseline(job.constraints, f"{uri}/constraints")
        for column, mapping in job.mappings.items():
            write_mapping(mapping, f"{uri}/mappings/{column}")
    return register_if_passed(job.entry, job.gate, registry)


@dataclass(frozen=True)
class ApprovedTabular:
    model: BoostedTrees
    mappings: dict[str, DataFrame]
    profile: DataFrame
    constraints: DataFrame


def approved_tabular(
    spark: SparkSession, registry: str, cfg: TabularConfig, group: str = "tabular"
) -> ApprovedTabular:
    """The newest approved model with its mappings of texts and its stored baselines."""
    uri = approved_uri(spark, registry, group)
    return ApprovedTabular(
        load_boosted(spark, f"{uri}/model"),
        {c: read_mapping(spark, f"{uri}/mappings/{c}") for c in cfg.encode},
        spark.read.parquet(f"{uri}/profile"),
        load_baseline(spark, f"{uri}/constraints"),
    )


@dataclass(frozen=True)
class TabularDrift:
    rows: DataFrame
    scored: DataFrame
    findings: DataFrame
    pairs: DataFrame
    metrics: DataFrame
    constraints: DataFrame
    violations: DataFrame


def check_tabular_drift(
    df: DataFrame,
    cfg: TabularConfig,
    mappings: Mapping[str, DataFrame],
    baseline_profile: DataFrame,
    model: BoostedTrees,
    constraints: DataFrame,
) -> TabularDrift:
    """Encode with stored maps, trim outliers, compare profile and metrics with the baselines."""
    rows = materialize(drift_rows(df, cfg, mappings))
    distances = distribution_distance(rows, baseline_profile)
    findings = materialize(data_check(column_profile(rows), baseline_profile, distances))
    scored = score(model, rows)
    pairs = _pairs(scored, cfg)
    metrics = materialize(regression_metrics(pairs, "label", "prediction"))
    violations = check_constraints(statistics_report(metrics), constraints)
    return TabularDrift(rows, scored, findings, pairs, metrics, constraints, violations)


def finish_tabular_drift(drift: TabularDrift, reports: str, run_date: str) -> None:
    """Capture the scored rows, write all reports, then fail on a violation or a finding."""
    capture(drift.scored, f"{reports}/captured", run_date)
    write_check(drift.metrics, drift.constraints, drift.violations, reports)
    drift.findings.write.mode("overwrite").json(f"{reports}/findings")
    found = drift.findings.select(F.concat_ws(" of ", "check", "column").alias("metric_name"))
    fail_on_violation(drift.violations.select("metric_name").unionByName(found))
