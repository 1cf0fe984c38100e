"""Forecast candidates against plain Python, and the global quantile model."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stockweave.operators.forecast import (
    FEATURES,
    auto_forecast,
    backtest_rows,
    candidates,
    fit_forecaster,
    load_forecaster,
    save_forecaster,
    forecast_rows,
    history,
    hold_out,
    pack_forecasts,
    score_forecaster,
    seasonal_naive,
    training_rows,
    weighted_history,
)
from stockweave.operators.pack import align_forecast, forecast_coverage, pack_series
from stockweave.operators.series import regularize, to_bins
from stockweave.session import scratch_path

BASE = dt.datetime(2024, 1, 1)


def series(n, seed):
    rng = random.Random(seed)
    return [float(rng.randint(0, 30)) for _ in range(n)]


def hist_of(spark, data, horizon=5, **settings):
    rows = [(k, BASE + dt.timedelta(days=d), v) for k, vs in data.items() for d, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "item string, ts timestamp, units double")
    bins = to_bins(df, "item", "ts", {"units": "mean"})
    regular = regularize(bins, "item", {"units": "linear"}, cut=hold_out(horizon))
    return regular, history(regular, "item", "ts", "units", horizon=horizon, **settings)


def test_smoothing_level_equals_recursion(spark):
    data = {"a": series(60, 1), "b": series(9, 2)}
    _, hist = hist_of(spark, data)
    got = {r["item"]: r["level"] for r in hist.collect()}
    for item, values in data.items():
        level = values[0]
        for v in values[1:-5]:
            level = 0.3 * v + 0.7 * level
        assert got[item] == pytest.approx(level, rel=1e-12)


@pytest.mark.parametrize("q", [0.1, 0.5, 0.9])
def test_weighted_history_equals_brute_force(spark, q):
    data = {"a": series(60, 3), "b": series(12, 4)}
    _, hist = hist_of(spark, data)
    rows = forecast_rows(hist, "item", {"w": weighted_history(5, q)}).collect()
    for item, values in data.items():
        context = values[:-5][-28:]
        weighted = sorted((v, i, math.exp((i - len(context) + 1) * 0.1)) for i, v in enumerate(context))
        total, cum = sum(w for _, _, w in weighted), 0.0
        for v, _, w in weighted:
            cum += w
            if cum >= q * total:
                break
        assert {r["prediction"] for r in rows if r["item"] == item} == {v}


def test_seasonal_naive_repeats_the_last_week(spark):
    data = {"a": series(30, 5), "short": series(9, 6)}
    _, hist = hist_of(spark, data, horizon=10)
    rows = forecast_rows(hist, "item", {"n": seasonal_naive(10)}).orderBy("step").collect()
    assert [r["prediction"] for r in rows] == (data["a"][13:20] * 2)[:10]
    assert rows[0]["ts"] == BASE + dt.timedelta(days=20)
    assert {r["item"] for r in rows} == {"a"}


def test_backtest_pairs_actuals_with_their_step(spark):
    data = {"a": series(40, 7)}
    _, hist = hist_of(spark, data)
    rows = backtest_rows(hist, "item", {"n": seasonal_naive(5)}).collect()
    assert [(r["target"], r["predictions"]) for r in rows] == list(zip(data["a"][-5:], data["a"][-12:-7]))
    assert rows[0]["scale"] == pytest.approx(
        sum(abs(data["a"][i] - data["a"][i - 7]) for i in range(7, 35)) / 28
    )


def test_auto_forecast_takes_the_lowest_metric(spark):
    weekly = [float(d % 7) * 10 + 1 for d in range(70)]
    _, hist = hist_of(spark, {"a": weekly}, horizon=14)
    scores, best = auto_forecast(hist, "item", candidates(14))
    assert best.first()["model"] == "seasonal_naive" and best.first()["wape"] == 0.0
    assert scores.count() == 3


def test_training_rows_follow_the_windows(spark):
    values = [float(i + 1) for i in range(70)]
    packed = spark.createDataFrame([("a", values), ("short", values[:40])], "item string, target array<double>")
    rows = training_rows(packed, "item", context=28, horizon=28, stride=7).collect()
    short = [r for r in rows if r["item"] == "short"]
    rows = [r for r in rows if r["item"] == "a"]
    assert len(rows) == 3 * 28
    # 40 bins: one window of the first 20, the other 20 are its future.
    assert len(short) == 20 and {r["known"] for r in short} == {20 / 28}
    assert sorted(r["step"] for r in short) == list(range(1, 21))
    step8 = next(r for r in short if r["step"] == 8)
    assert step8["label"] == pytest.approx(28 / 10.5) and step8["week_1"] == pytest.approx(14 / 10.5)
    assert {r["known"] for r in rows} == {1.0}
    first = next(r for r in rows if r["step"] == 1 and r["last_value"] * 14.5 == 28)
    assert first["label"] == pytest.approx(29 / 14.5)
    assert first["week_1"] == pytest.approx(22 / 14.5)
    assert first["week_2"] == pytest.approx(15 / 14.5)
    assert first["recent_mean"] == pytest.approx(25 / 14.5)
    assert set(FEATURES) < set(rows[0].asDict())


def test_quantile_model_is_calibrated_deterministic_and_covers_short_items(spark):
    data = {f"i{k}": [10 + 5 * (d % 7) + random.Random(k * 999 + d).random() * 10 for d in range(200)] for k in range(8)}
    data["short"] = series(40, 1)
    regular, _ = hist_of(spark, data, horizon=28)
    train = pack_series(regular.filter("pos < cut_pos"), "item", "ts", "units")
    model = fit_forecaster(train, "item", quantiles=(0.5, 0.9))
    none = spark.createDataFrame([("empty", []), ("null", None), ("nulls", [None] * 30)], "item string, target array<double>")
    contexts = train.select("item", "target").unionByName(none)
    records = score_forecaster(model, contexts, "item")
    errors = {r["item"]: r["error"] for r in records.collect()}
    assert {k for k, v in errors.items() if v is not None} == {"empty", "null", "nulls"}
    assert len(records.filter("item = 'short'").first()["quantiles"]["0.5"]) == 28
    assert forecast_coverage(contexts, records, "item").first() == (12, 9, 3)
    actuals = pack_series(regular.filter("pos >= cut_pos"), "item", "ts", "units")
    for q in (0.5, 0.9):
        rows = align_forecast(actuals, records.filter("error IS NULL AND item <> 'short'"), "item", 28, str(q))
        share = rows.agg(F.avg((F.col("target") <= F.col("predictions")).cast("double"))).first()[0]
        assert rows.count() == 8 * 28
        assert abs(share - q) < 0.1
    again = score_forecaster(fit_forecaster(train, "item", quantiles=(0.5, 0.9)), contexts, "item")
    path = scratch_path(spark, "forecaster")
    save_forecaster(model, path)
    loaded = score_forecaster(load_forecaster(spark, path), contexts, "item")
    key = lambda r: r["item"]
    assert sorted(records.collect(), key=key) == sorted(loaded.collect(), key=key)
    assert sorted(records.collect(), key=key) == sorted(again.collect(), key=key)


def test_forecast_rows_pack_into_records(spark):
    _, hist = hist_of(spark, {"a": series(30, 5)}, horizon=3)
    rows = forecast_rows(hist, "item", {"n": seasonal_naive(3)})
    record = pack_forecasts(rows, "item").first()
    assert record["quantiles"]["0.5"] == [r["prediction"] for r in rows.orderBy("step").collect()]
    assert record["error"] is None


def _hist(spark, values, horizon=2):
    from stockweave.operators.forecast import history

    rows = [(item, i, v, len(vs) - horizon) for item, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "item string, pos int, v double, cut_pos int")
    return history(df.withColumn("ts", F.timestamp_add("DAY", F.col("pos"), F.lit("2024-01-01").cast("timestamp"))), "item", "ts", "v", horizon=horizon)


def test_smoothing_starts_at_the_first_value(spark):
    series = {"a": [None] * 3 + [10.0] * 9, "b": [1.0, 5.0, 2.0, 8.0, 4.0, 4.0], "c": [None] * 6}

    def recursion(values, alpha=0.3):
        level = None
        for v in values:
            if v is not None:
                level = v if level is None else alpha * v + (1 - alpha) * level
        return level

    got = {r["item"]: r["level"] for r in _hist(spark, series).collect()}
    assert got["a"] == pytest.approx(10.0) and got["c"] is None
    assert got["b"] == pytest.approx(recursion(series["b"][:4]))


def test_candidates_are_scored_on_the_same_rows(spark):
    from stockweave.operators.forecast import auto_forecast, candidates

    series = {"long": [float(i % 7 + 1) for i in range(20)], "short": [3.0, 4.0, 5.0, 6.0, 7.0]}
    scores, _ = auto_forecast(_hist(spark, series), "item", candidates(2))
    assert {r["item_count"] for r in scores.collect()} == {2}
