"""Metrics, constraints, gates, registry and reports."""

import json
import math

import numpy as np
import pytest

from stockweave.operators.metrics import forecast_metrics, regression_metrics, seasonal_scale
from stockweave.operators.quality import (
    ConstraintViolation,
    build_constraints,
    check_constraints,
    compare_baseline,
    fail_on_violation,
    quality_gate,
    statistics_report,
    violation_status,
)
from stockweave.operators.registry import (
    APPROVED,
    PENDING,
    latest_approved,
    approve_model,
    read_registry,
    register_model,
    registry_entry,
    top_model,
)
from stockweave.session import scratch_path
from stockweave.sources.reports import (
    constraints_json,
    evaluation_json,
    json_metric,
    load_baseline,
    read_report,
    save_baseline,
    statistics_json,
    violations_json,
    write_report,
)


def pairs(spark, rows):
    return spark.createDataFrame(rows, "target double, predictions double")


def stats(spark, **values):
    return spark.createDataFrame(list(values.items()), "metric string, value double")


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.random(500) * 50, rng.random(500) * 50
    row = regression_metrics(pairs(spark, list(zip(y.tolist(), p.tolist()))), mape_scale=100).first()
    assert row["item_count"] == 500
    assert row["mse"] == pytest.approx(np.mean((y - p) ** 2))
    assert row["rmse"] == pytest.approx(math.sqrt(np.mean((y - p) ** 2)))
    assert row["std"] == pytest.approx(np.std(y - p))
    assert row["mape"] == pytest.approx(100 * np.mean(np.abs((y - p) / (y + 0.001))))
    assert row["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


@pytest.mark.parametrize(
    "rows, r2",
    [
        ([(2.0, 2.0), (2.0, 2.0)], 1.0),
        ([(2.0, 2.0), (2.0, 3.0)], 0.0),
        ([(0.1, 0.1)] * 3, 1.0),
        ([(2.0, 2.0)], None),
    ],
)
def test_r2_of_constant_actuals(spark, rows, r2):
    assert regression_metrics(pairs(spark, rows)).first()["r2"] == r2


def test_unscored_rows_and_zero_denominators(spark):
    row = regression_metrics(pairs(spark, [(1.0, None), (None, 1.0), (-0.001, 1.0), (2.0, 2.0)])).first()
    assert row["item_count"] == 2
    assert row["mape"] == 0.0


def test_forecast_metrics_by_hand(spark):
    df = spark.createDataFrame(
        [("m", 4.0, 2.0, 2.0), ("m", 0.0, 1.0, 2.0), ("m", 6.0, 6.0, 0.0)],
        "model string, target double, predictions double, scale double",
    )
    row = forecast_metrics(df, by=["model"]).first()
    assert row["wape"] == pytest.approx(3 / 10)
    assert row["rmse"] == pytest.approx(math.sqrt(5 / 3))
    assert row["mase"] == pytest.approx((1.0 + 0.5) / 2)
    assert row["mape"] == pytest.approx((0.5 + 0.0) / 2)
    assert row["zero_share"] == pytest.approx(1 / 3)


def test_seasonal_scale(spark):
    df = spark.createDataFrame([("a", i, float(i * i)) for i in range(10)], "item string, pos int, v double")
    want = np.mean([abs(i * i - (i - 7) ** 2) for i in range(7, 10)])
    assert seasonal_scale(df, "item", "v").first()["scale"] == pytest.approx(want)


def test_a_baseline_never_violates_itself(spark):
    report = statistics_report(regression_metrics(pairs(spark, [(1.0, 2.0), (5.0, 3.0), (2.0, 2.0)])))
    assert check_constraints(report, build_constraints(report)).isEmpty()


def test_violations_follow_the_operator(spark):
    base = build_constraints(stats(spark, mape=1.0, mse=1.0, rmse=1.0, r2=0.5))
    worse = check_constraints(stats(spark, mape=0.5, mse=1.0, rmse=2.5, r2=0.25), base)
    rows = {r["metric_name"]: r for r in worse.collect()}
    assert set(rows) == {"rmse", "r2"}
    assert rows["rmse"]["description"] == "rmse is 2.5, which breaks the rule GreaterThanThreshold 1.0"
    assert rows["r2"]["constraint_check_type"] == "LessThanThreshold"


def test_nan_never_violates(spark):
    nan = float("nan")
    base = build_constraints(stats(spark, rmse=1.0, r2=0.5, mse=nan))
    now = stats(spark, rmse=nan, r2=nan, mse=9.0)
    assert check_constraints(now, base).isEmpty()
    assert [r["violated"] for r in compare_baseline(now, base).collect()] == [False] * 3


def test_failing_and_registering(spark):
    base = build_constraints(stats(spark, rmse=1.0))
    bad = check_constraints(stats(spark, rmse=2.0), base)
    assert tuple(violation_status(bad).first()) == (1, True)
    with pytest.raises(ConstraintViolation):
        fail_on_violation(bad)
    fail_on_violation(check_constraints(stats(spark, rmse=1.0), base))


def test_registering_a_baseline_never_fails(spark):
    bad = check_constraints(stats(spark, rmse=2.0), build_constraints(stats(spark, rmse=1.0)))
    fail_on_violation(bad, registering=True)
    with pytest.raises(ConstraintViolation):
        fail_on_violation(bad, registering=False)


@pytest.mark.parametrize("value, passed", [(8.0, True), (8.1, False), (float("nan"), False), (None, False)])
def test_gate(spark, value, passed):
    df = spark.createDataFrame([(value,)], "rmse double")
    assert quality_gate(df, "rmse", 8).first()["passed"] is passed


def test_reports_have_the_documented_layout(spark):
    metrics = regression_metrics(pairs(spark, [(1.0, 2.0), (5.0, 3.0)]))
    evaluation = json.loads(evaluation_json(metrics).first()["value"])
    assert set(evaluation["regression_metrics"]["rmse"]) == {"value", "standard_deviation"}
    statistics = json.loads(statistics_json(metrics).first()["value"])
    assert statistics["version"] == 0.0 and statistics["dataset"]["item_count"] == 2
    assert list(statistics["timeseries_forecast_metrics"]) == ["mape", "mse", "rmse", "r2"]
    base = build_constraints(statistics_report(metrics))
    constraints = json.loads(constraints_json(base).first()["value"])
    entry = constraints["timeseries_forecast_metrics"]["r2"]
    assert entry["comparison_operator"] == "LessThanThreshold"
    found = check_constraints(stats(spark, rmse=99.0), base)
    document = json.loads(violations_json(found).first()["value"])
    assert set(document["violations"][0]) == {"constraint_check_type", "description", "metric_name"}
    path = scratch_path(spark, "report")
    write_report(evaluation_json(metrics), path)
    value = json_metric(read_report(spark, path)).first()["value"]
    assert value == pytest.approx(evaluation["regression_metrics"]["rmse"]["value"])


def test_nan_is_written_as_missing(spark):
    metrics = spark.createDataFrame([(float("nan"), 1.0)], "rmse double, std double")
    assert json.loads(evaluation_json(metrics).first()["value"]) == {
        "regression_metrics": {"rmse": {"standard_deviation": 1.0}}
    }
    assert json_metric(evaluation_json(metrics)).first()["value"] is None


def test_baseline_round_trip(spark):
    base = build_constraints(stats(spark, mape=1.5, mse=2.5, rmse=3.5, r2=-0.5))
    path = scratch_path(spark, "baseline")
    save_baseline(base, path)
    assert sorted(map(tuple, load_baseline(spark, path).collect())) == sorted(map(tuple, base.collect()))


def test_registry(spark):
    path = scratch_path(spark, "registry")
    metrics = spark.createDataFrame([(1.0, 2.0)], "rmse double, std double")
    for uri, created, status in [
        ("m/1", "2024-01-01", APPROVED),
        ("m/2", "2024-03-01", APPROVED),
        ("m/3", "2024-04-01", PENDING),
    ]:
        register_model(registry_entry(metrics, "g", uri, created, status), path)
    # A repeated registration replaces its row, and only that.
    register_model(registry_entry(metrics, "g", "m/1", "2024-02-01", APPROVED), path)
    approve_model(spark, path, "m/3", "2024-01-15")
    approve_model(spark, path, "m/3", "2024-01-16")
    registry = read_registry(spark, path)
    assert registry.count() == 4
    assert [str(r["created"]) for r in registry.filter("uri = 'm/3'").orderBy("status").collect()] == ["2024-01-16 00:00:00", "2024-04-01 00:00:00"]
    assert latest_approved(registry, "g").first()["uri"] == "m/2"
    assert latest_approved(registry, "other").isEmpty()


def test_top_model_ignores_nan(spark):
    rows = [("a", float("nan")), ("b", 2.0), ("c", 1.0), ("d", None)]
    trials = spark.createDataFrame(rows, "model string, wape double")
    assert [r["model"] for r in top_model(trials, "wape", 2).collect()] == ["c", "b"]


