"""The composite jobs end to end on the small tables."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bindings import ORACLES, QUERIES
from bindings.jobs import CREATED, _ads, _campaign, _retail, _tabular_config
from bindings.models import FEATURES, TARGET, lines
from stockweave.config import AutoForecastConfig, SeriesConfig
from stockweave.operators.quality import ConstraintViolation, quality_gate
from stockweave.operators.registry import approve_model, read_registry
from stockweave.operators.metrics import regression_metrics
from stockweave.operators.tabular import SEARCH_RANGES, score_projection, search
from stockweave.operators.forecast import load_forecaster, score_forecaster
from stockweave.plans.auto_forecast_job import AUTOREGRESSION, GLOBAL, STATES, TREND, publish_auto_forecast, run_auto_forecast, target_dataset
from stockweave.plans.series_jobs import (
    SeriesDrift,
    approved_series,
    check_series_drift,
    publish_series,
    score_series_drift,
    train_series,
)
from stockweave.plans.tabular_jobs import check_tabular_drift, train_tabular, training_rows
from stockweave.session import scratch_path
from stockweave.sources.reports import json_metric, read_report
from stockweave.sources.series_json import read_series_json, write_series_json


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    return train_series(
        _retail(spark, sf_dir), _ads(spark, sf_dir), SeriesConfig(), "models/1", CREATED
    )


def test_series_training_parts(spark, trained):
    sizes = trained.train.join(
        trained.validation.select("item", F.size("target").alias("v")), "item"
    ).select(F.size("target").alias("t"), "v")
    assert all(r["t"] == int((r["t"] + r["v"]) * 0.85) for r in sizes.collect())
    codes = sorted(r["cat"] for r in trained.train.collect())
    assert codes == list(range(len(codes)))
    assert all(r["n"] == 28 for r in trained.contexts.select(F.size("target").alias("n")).collect())
    row = trained.metrics.first()
    assert row["item_count"] == 28 * len(codes)
    assert trained.gate.first()["passed"] == (row["rmse"] <= 8.0)
    assert trained.entry.first()["metrics"]["rmse"] == pytest.approx(row["rmse"])


def test_packed_parts_can_be_written_and_read(spark, trained):
    path = scratch_path(spark, "train")
    write_series_json(trained.train, path)
    assert read_series_json(spark, path).count() == trained.train.count()


def test_drift_baseline_then_violation(spark, sf_dir, trained):
    cfg = SeriesConfig(how="mean")
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    drift = score_series_drift(rows, trained.mapping, trained.model, cfg)
    path = scratch_path(spark, "baseline")
    assert check_series_drift(drift, path, register_baseline=True).isEmpty()
    assert check_series_drift(drift, path).isEmpty()
    worse = score_series_drift(
        rows.withColumn("units", F.col("units") + F.pmod(F.hash("ts"), F.lit(40))),
        trained.mapping,
        trained.model,
        cfg,
        cutoff="midpoint",
    )
    with pytest.raises(ConstraintViolation):
        check_series_drift(worse, path)


def test_unseen_items_share_a_code_but_stay_apart(spark, sf_dir, trained):
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    new = rows.filter("item < 2").withColumn("item", F.col("item") + 5000)
    drift = score_series_drift(
        rows.unionByName(new), trained.mapping, trained.model, SeriesConfig(how="mean")
    )
    found = drift.rows.filter("cat = 100").select("item").distinct().collect()
    assert sorted(r["item"] for r in found) == [5000, 5001]


def test_tabular_training_and_drift(spark, sf_dir):
    cfg = replace(_tabular_config(0), rounds=20)
    job = train_tabular(_campaign(spark, sf_dir), cfg, "models/2", CREATED)
    assert job.metrics.first()["item_count"] == job.pairs.count() > 0
    same = check_tabular_drift(
        _campaign(spark, sf_dir), cfg, job.mappings, job.profile, job.model, job.constraints
    )
    assert same.rows.columns == ["units", *cfg.features]
    assert same.findings.filter("check <> 'distribution'").isEmpty()
    unseen = _campaign(spark, sf_dir).withColumn("ad_group_name", F.lit("new"))
    none = check_tabular_drift(unseen, cfg, job.mappings, job.profile, job.model, job.constraints)
    assert none.rows.isEmpty()


@pytest.mark.parametrize("limit, passes", [(1000.0, True), (0.0, False)])
def test_only_a_passed_gate_registers_and_saves(spark, trained, limit, passes):
    root = scratch_path(spark, "publish")
    entry = trained.entry.withColumn("uri", F.lit(f"{root}/model"))
    job = replace(trained, entry=entry, gate=quality_gate(trained.metrics, "rmse", limit))
    assert publish_series(job, f"{root}/registry", f"{root}/reports") is passes
    assert read_registry(spark, f"{root}/registry").count() == int(passes)
    assert json_metric(read_report(spark, f"{root}/reports/evaluation")).first()["value"] == trained.metrics.first()["rmse"]
    with pytest.raises(ValueError):
        approved_series(spark, f"{root}/registry", "bigint")
    if passes:
        approve_model(spark, f"{root}/registry", f"{root}/model", "2024-02-01")
        model, mapping = approved_series(spark, f"{root}/registry", "bigint")
        assert model.season == 7 and mapping.count() == trained.mapping.count()
    else:
        with pytest.raises(ValueError):
            approve_model(spark, f"{root}/registry", f"{root}/model", "2024-02-01")


def test_short_items_are_trained_and_scored(spark):
    bins = {"a": 200, "b": 32, "c": 29, "d": 28}
    rows = [(k, "2024-01-01", i, float(i % 7 + 1)) for k, n in bins.items() for i in range(n)]
    df = spark.createDataFrame(rows, "item string, d string, i int, units double")
    df = df.select("item", F.timestamp_add("DAY", "i", F.to_timestamp("d")).alias("ts"), "units")
    job = train_series(df, None, SeriesConfig(), "models/short", CREATED)
    # 28 bins are below the least history; 32 and 29 bins leave 5 to validate.
    assert job.coverage.first() == (3, 3, 0)
    assert job.metrics.first()["item_count"] == 28 + 5 + 5


def test_rejected_items_fail_the_drift_check(spark, trained):
    lost = spark.createDataFrame([(3, 2, 1)], "eligible long, scored long, rejected long")
    drift = SeriesDrift(None, lost, trained.metrics, None, None)
    with pytest.raises(ValueError):
        check_series_drift(drift, "unused")


def test_reports_are_written_before_a_rejected_item_fails(spark, sf_dir, trained):
    """An item whose bins are all null has no forecast."""
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    none = rows.filter("item = 1").withColumns({"item": F.lit(7777).cast(rows.schema["item"].dataType), "units": F.lit(None).cast("double")})
    drift = score_series_drift(rows.unionByName(none), trained.mapping, trained.model, SeriesConfig(how="mean"))
    assert drift.coverage.first()["rejected"] == 1
    root = scratch_path(spark, "rejected")
    with pytest.raises(ValueError, match="1 items"):
        check_series_drift(drift, f"{root}/baseline", register_baseline=True, reports=f"{root}/reports")
    for name in ("statistics", "constraints", "violations"):
        assert read_report(spark, f"{root}/reports/{name}").count() == 1
    with pytest.raises(Exception):
        read_report(spark, f"{root}/baseline").count()


def test_rows_without_a_key_are_split(spark, sf_dir):
    cfg = replace(_tabular_config(0), row_key=None)
    rows, _ = training_rows(_campaign(spark, sf_dir).drop("row_id"), cfg)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    share = rows.filter("split = 'train'").count() / rows.count()
    assert abs(share - 0.7) < 0.05


def test_search_stays_in_range_and_repeats(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("w", F.lit(8.0))
    train, validation = rows.filter("split = 'train'"), rows.filter("split = 'validation'")
    model, one = search(train, validation, TARGET, FEATURES, trials=3, parallel=2, rounds=4, weight="w")
    _, two = search(train.repartition(3), validation, TARGET, FEATURES, trials=3, parallel=2, rounds=4, weight="w")
    found = one.orderBy("trial").collect()
    assert [r["trial"] for r in found] == [0, 1, 2]
    for r in found:
        assert all(lo <= r[k] <= hi for k, (lo, hi) in SEARCH_RANGES.items())
    assert [r["rmse"] for r in found] == pytest.approx([r["rmse"] for r in two.orderBy("trial").collect()])
    pairs = score_projection(model, validation, TARGET)
    assert regression_metrics(pairs, "label", "prediction").first()["rmse"] == pytest.approx(min(r["rmse"] for r in found))
    # Earlier trials guide the search and are not run again.
    _, more = search(train, validation, TARGET, FEATURES, trials=1, rounds=1, weight="w", known=one)
    assert more.count() == 1


def test_auto_forecast_scores_only_known_bins(spark, sf_dir):
    cfg = AutoForecastConfig(cutoff="2000-12-31", global_model=False)
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    late = F.col("ts") >= F.lit("2000-12-31").cast("timestamp_ntz")
    changed = rows.withColumn("units", F.when(late, F.col("units") * 100).otherwise(F.col("units")))
    key = lambda r: r["model"]
    before = sorted(run_auto_forecast(rows, cfg, "m", CREATED).scores.collect(), key=key)
    after = sorted(run_auto_forecast(changed, cfg, "m", CREATED).scores.collect(), key=key)
    assert before == after
    root = scratch_path(spark, "publish-auto")
    job = run_auto_forecast(rows, cfg, f"{root}/model", CREATED)
    assert job.best.first()["wape"] == min(r["wape"] for r in before)
    assert job.gate.first()["passed"] == (job.best.first()["rmse"] <= 30)
    passed = publish_auto_forecast(job, f"{root}/registry", f"{root}/reports")
    assert read_registry(spark, f"{root}/registry").count() == int(passed)
    reported = json_metric(read_report(spark, f"{root}/reports/evaluation")).first()["value"]
    assert reported == job.best.first()["rmse"]


def test_model_over_all_items_competes_and_is_saved(spark):
    # Value 10 with a 50 on every fifth day: a season of 7 misses it, the median model answers 10.
    day = "CAST(timestamp'2023-01-01' + make_dt_interval(d) AS timestamp) AS ts"
    value = "IF((d + i) % 5 = 0, 50.0D, 10.0D) + i AS units"
    rows = spark.range(6).withColumnRenamed("id", "i").selectExpr("i", "explode(sequence(0, 399)) AS d")
    rows = rows.selectExpr("concat('item', i) AS item", day, value)
    root = scratch_path(spark, "publish-global")
    cfg = AutoForecastConfig(cutoff="2024-02-05", rmse_gate=100.0)
    job = run_auto_forecast(rows, cfg, f"{root}/best", CREATED)
    scores = {r["model"]: r for r in job.scores.collect()}
    assert set(scores) == {"seasonal_naive", "smoothing", "weighted_history", STATES, AUTOREGRESSION, TREND, GLOBAL}
    assert {r["item_count"] for r in scores.values()} == {6 * cfg.horizon}
    # The score is that of the paths beside the held-out bins.
    pairs = [
        (y, p)
        for r in job.history.collect()
        for y, p in zip(r["actual"], r["global_path"])
    ]
    wape = sum(abs(y - p) for y, p in pairs) / sum(abs(y) for y, _ in pairs)
    assert scores[GLOBAL]["wape"] == pytest.approx(wape)
    # Held-out bins teach nothing: other values in them leave the paths as they are.
    paths = {r["item"]: r["global_path"] for r in job.history.collect()}
    late = F.col("ts") >= F.lit("2024-01-12").cast("timestamp")
    other = rows.withColumn("units", F.when(late, F.col("units") * 100).otherwise(F.col("units")))
    for r in run_auto_forecast(other, cfg, "m", CREATED).history.collect():
        assert max(r["actual"]) > 1000 and r["global_path"] == pytest.approx(paths[r["item"]])
    best = job.best.first()["model"]
    assert scores[best]["wape"] == min(r["wape"] for r in scores.values())
    assert publish_auto_forecast(job, f"{root}/registry", f"{root}/reports")
    assert spark.read.parquet(f"{root}/best/best").first()["model"] == best
    assert best == GLOBAL
    kept = load_forecaster(spark, f"{root}/best/model")
    again = score_forecaster(kept, job.history.selectExpr("item", "context AS target"), "item")
    for r in again.collect():
        assert r["quantiles"]["0.5"] == pytest.approx(paths[r["item"]])


def test_target_dataset_has_the_declared_columns(spark, sf_dir):
    cfg = AutoForecastConfig(cutoff="2000-12-31")
    out = target_dataset(_retail(spark, sf_dir).select("item", "ts", "units"), cfg)
    assert dict(out.dtypes) == {
        "timestamp": "string",
        "target_value": "float",
        "item_id": "string",
        "has_cam": "string",
        "split": "string",
    }


def test_queries_without_sql_return_rows(spark, sf_dir):
    weaker = set(QUERIES) - set(ORACLES)
    assert weaker == {
        "job_auto_forecast_global",
        "param_search",
        "quantile_forecast_metrics",
        "quantile_forest_coverage",
    }


def test_mean_mode_averages_observations_under_view_preference(spark):
    from stockweave.plans.series_jobs import clean_retail, regular_sales

    rows = [("a", "2024-01-01", 2.0, "Manufacturing"), ("a", "2024-01-01", 4.0, "Manufacturing"), ("a", "2024-01-01", 9.0, "Sourcing")]
    df = spark.createDataFrame(rows, "item string, ts string, units double, distributor_view string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    assert clean_retail(df, SeriesConfig(how="mean")).count() == 2
    for how, want in (("mean", 3.0), ("sum", 6.0)):
        cfg = SeriesConfig(how=how, min_bins=1)
        assert [r["units"] for r in regular_sales(df, None, cfg).collect()] == [want]
