"""Exact quantiles without exploded rows, and profile states that merge."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from stockweave.operators.profile import DECILES, column_profile, data_check, distribution_distance
from stockweave.operators.profile_state import merge_states, profile_of, profile_state
from stockweave.operators.quantiles import distinct_counts, exact_quantiles
from stockweave.session import scratch_path
from stockweave.sources.profiles import read_states, write_states


def _rows(n):
    rng = np.random.default_rng(11)
    normal, free = rng.normal(size=n), rng.random(n) * 10
    start = datetime.date(2024, 1, 1)
    return [
        (
            float(normal[i]),
            7.0 if i % 3 == 0 else 1e300 if i == 1 else float(free[i]),
            i % 4,
            None,
            math.nan if i % 10 == 0 else float(i),
            f"t{i % 900}",
            start + datetime.timedelta(days=i % 5),
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def data():
    """Enough rows for narrow brackets: a normal, a hot value with a far end, few values, an empty column, NaN."""
    return _rows(60_000)


@pytest.fixture(scope="module")
def wide(spark, data):
    schema = "normal double, hot double, few bigint, none double, holed double, text string, day date"
    return spark.createDataFrame(data, schema).repartition(6)


def test_exact_quantiles_equal_numpy(wide, data):
    names = ["normal", "hot", "few", "none", "holed"]
    wanted = [0.0, 0.001, *DECILES, 0.9999, 1.0]
    got = {r["column"]: r["quantiles"] for r in exact_quantiles(wide, names, wanted).collect()}
    assert set(got) == {"normal", "hot", "few", "holed"}
    for i, name in enumerate(names):
        values = np.array([r[i] for r in data if r[i] is not None and not math.isnan(r[i])])
        if len(values):
            np.testing.assert_allclose(got[name], np.quantile(values, wanted), rtol=1e-12)


def test_only_rows_near_the_quantiles_are_counted(spark, wide, monkeypatch):
    from stockweave.operators import quantiles

    seen = []
    total = quantiles.running_total
    monkeypatch.setattr(quantiles, "running_total", lambda df, *rest: seen.append(df) or total(df, *rest))
    exact_quantiles(wide, ["normal"], DECILES).collect()
    assert seen[0].agg(F.sum("n")).first()[0] <= 60_000 * 9 * 2 * (quantiles.MARGIN + 1) / quantiles.ACCURACY + 18
    assert "Generate" not in plan_of(seen[0])


def test_distinct_counts(wide):
    got = {r["column"]: r["n_distinct"] for r in distinct_counts(wide, wide.columns).collect()}
    assert got == {"normal": 60_000, "hot": 40_001, "few": 4, "none": 0, "holed": 54_000, "text": 900, "day": 5}


def test_distinct_counts_of_large_integers_stay_apart(spark):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,), (None,)], "x long")
    assert distinct_counts(df, ["x"]).first()["n_distinct"] == 2
    assert column_profile(df, exact=True).first()["n_distinct"] == 2


def test_empty_tables(spark, wide):
    empty = wide.limit(0)
    assert exact_quantiles(empty, ["normal"], DECILES).count() == 0
    rows = {r["column"]: r for r in column_profile(empty, exact=True).collect()}
    assert rows["normal"]["n_distinct"] == 0 and rows["normal"]["deciles"] is None
    merged = profile_of(merge_states(profile_state(empty))).collect()
    assert {r["n_rows"] for r in merged} == {0} and {r["n_distinct"] for r in merged} == {0}
    assert merge_states(profile_state(empty, by=["day"])).count() == 0


def test_merged_states_equal_the_whole(spark, wide):
    exact = {r["column"]: r for r in column_profile(wide.drop("day"), exact=True).collect()}
    merged = merge_states(profile_state(wide, by=["day"]))
    twice = merge_states(merged.unionByName(merged))
    got = {r["column"]: r for r in profile_of(merged).collect()}
    assert set(got) == set(exact)
    for name, want in exact.items():
        for field in ("data_type", "n_rows", "n_present", "completeness", "min", "max", "non_negative"):
            assert got[name][field] == want[field], (name, field)
        for field in ("sum", "mean", "std"):
            if want[field] is None:
                assert got[name][field] is None
            elif name != "hot":  # its sums are those of one huge value
                assert got[name][field] == pytest.approx(want[field], rel=1e-9)
        assert got[name]["n_distinct"] == pytest.approx(want["n_distinct"], rel=0.06)
    values = sorted(r["normal"] for r in wide.select("normal").collect())
    ranks = np.searchsorted(values, got["normal"]["deciles"]) / len(values)
    np.testing.assert_allclose(ranks, DECILES, atol=0.005)
    again = {r["column"]: r for r in profile_of(twice).collect()}
    assert again["normal"]["n_rows"] == 120_000
    assert again["normal"]["std"] == pytest.approx(exact["normal"]["std"])
    assert again["text"]["n_distinct"] == pytest.approx(900, rel=0.06)


def test_moments_far_from_zero_keep_their_digits(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 2 + 1e9).alias("x"), (F.col("id") % 7).alias("part"))
    row = profile_of(merge_states(profile_state(df, by=["part"]))).first()
    assert row["std"] == pytest.approx(0.5, abs=1e-6)


def test_a_merged_profile_is_a_baseline(wide):
    frame = wide.drop("day")
    base = profile_of(merge_states(profile_state(wide, by=["day"])))
    distances = {r["column"]: r["distance"] for r in distribution_distance(frame, base).collect()}
    assert distances["normal"] < 0.01
    assert data_check(column_profile(frame), base).count() == 0
    moved = distribution_distance(frame.withColumn("normal", F.col("normal") + 3), base)
    assert {r["column"]: r["distance"] for r in moved.collect()}["normal"] > 0.5


def test_a_changed_type_is_reported(spark, wide):
    frame = wide.select("few")
    both = profile_state(frame).unionByName(profile_state(frame.withColumn("few", F.col("few").cast("string"))))
    found = data_check(column_profile(frame), profile_of(merge_states(both)))
    assert [(r["column"], r["check"]) for r in found.collect()] == [("few", "data_type")]


def test_stored_states_are_replaced_per_run_date(spark, wide):
    path = scratch_path(spark, "states")
    for day in ("2024-01-01", "2024-01-02"):
        write_states(profile_state(wide.filter(F.col("day") == day).drop("day")), path, day)
    write_states(profile_state(wide.filter("day = date'2024-01-02'").drop("day")), path, "2024-01-02")
    rows = lambda **span: profile_of(merge_states(read_states(spark, path, **span))).first()["n_rows"]
    assert rows() == 24_000
    assert rows(since="2024-01-02") == rows(until="2024-01-01") == 12_000
