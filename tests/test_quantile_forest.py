"""Quantile forest, its mergeable leaves and the level of an item's code."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.operators import forecast
from stockweave.operators.forecast import item_levels, training_rows
from stockweave.operators.pack import align_forecast, pack_series
from stockweave.operators.quantile_forest import (
    fit_forest,
    fit_forest_forecaster,
    forest_levels,
    leaf_quantiles,
    leaf_sketch,
    load_forest,
    merge_sketches,
    score_forest_forecaster,
    value_grid,
    with_cell,
    with_leaves,
)
from stockweave.session import scratch_path

QUANTILES = (0.1, 0.5, 0.9)


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # The spread grows with the quantity, so quantiles differ by more than a shift.
    noise = (F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(1000)) / 1000 - 0.5) * F.col("l_quantity")
    return rows.select("l_orderkey", "l_quantity", "l_tax", (F.col("l_quantity") * 2 + noise).alias("label")).cache()


@pytest.fixture(scope="module")
def forest(lines):
    return fit_forest(lines.filter("l_orderkey % 4 <> 0"), ["l_quantity", "l_tax"], trees=8)


def test_quantiles_cover_their_share(lines, forest):
    test = forest_levels(forest, lines.filter("l_orderkey % 4 = 0"), QUANTILES)
    shares = test.agg(*[F.avg((F.col("label") <= F.col("levels")[i]).cast("double")) for i in range(3)]).first()
    assert all(abs(got - q) < 0.06 for got, q in zip(shares, QUANTILES))
    spread = test.groupBy(F.col("l_quantity") > 25).agg(F.avg(F.col("levels")[2] - F.col("levels")[0]).alias("w")).orderBy("w").collect()
    assert spread[1]["w"] > 1.5 * spread[0]["w"]


def test_both_ways_of_reading_the_leaves_agree(lines, forest):
    some = lines.select("l_quantity", "l_tax").distinct()
    fast = {(r[0], r[1]): list(r["levels"]) for r in forest_levels(forest, some, QUANTILES).collect()}
    joined = leaf_quantiles(with_leaves(forest.forest, some, forest.features), forest.sketch, ["l_quantity", "l_tax"], QUANTILES)
    slow = {(r[0], r[1]): [forest.grid[c] for c in r["cells"]] for r in joined.collect()}
    assert fast == slow and len(fast) > 100


def test_leaves_equal_a_weighted_quantile_by_hand(spark):
    rows = [([i % 3, i % 2], float((i * 7) % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "leaves array<int>, value double")
    grid = value_grid(df, "value")
    assert grid == [float(x) for x in range(11)]
    sketch = leaf_sketch(with_cell(df, "value", grid))
    found = leaf_quantiles(df.select("leaves").distinct(), sketch, ["leaves"], QUANTILES).collect()
    assert len(found) == 6
    for r in found:
        weight = np.zeros(11)
        for t, leaf in enumerate(r["leaves"]):
            own = [v for leaves, v in rows if leaves[t] == leaf]
            for v in own:
                weight[int(v)] += 1 / len(own) / 2
        want = [int((np.cumsum(weight) >= q - 1e-9).argmax()) for q in QUANTILES]
        assert r["cells"] == want


def test_sketches_of_parts_merge_to_the_whole(lines, forest):
    members = with_cell(with_leaves(forest.forest, lines, forest.features), "label", forest.grid)
    whole = leaf_sketch(members)
    parts = merge_sketches(*[leaf_sketch(members.filter(F.col("l_orderkey") % 3 == k)) for k in range(3)])
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_cells_of_many_values_hold_like_shares(spark):
    df = spark.range(50_000).select((F.col("id") * 1.5).alias("v"))
    grid = value_grid(df, "v", 16)
    sizes = [r["count"] for r in with_cell(df, "v", grid).groupBy("cell").count().collect()]
    assert len(grid) == 16 and max(sizes) - min(sizes) < 100
    below = with_cell(spark.createDataFrame([(-5.0,), (0.0,)], "v double"), "v", grid)
    assert [r["cell"] for r in below.collect()] == [0, 0]


def test_saved_forests_answer_alike_and_empty_input_raises(spark, lines, forest):
    path = scratch_path(spark, "forest")
    for _ in range(2):
        forest.save(path)
    some = lines.select("l_quantity", "l_tax").distinct()
    one, two = (sorted(map(str, forest_levels(m, some, [0.25]).collect())) for m in (forest, load_forest(spark, path)))
    assert one == two
    with pytest.raises(ValueError):
        fit_forest(lines.limit(0), ["l_quantity"])


# ------------------------------------------------------------ item levels


def packed_of(spark, series):
    rows = [(k, f"2024-01-{1 + start:02d}", v) for k, (start, v) in series.items()]
    return spark.createDataFrame(rows, "item string, d string, target array<double>").select("item", F.to_timestamp("d").alias("start"), "target")


def test_levels_equal_running_sums_of_any_length(spark, monkeypatch):
    monkeypatch.setattr(forecast, "CHUNK", 4)
    draw = random.Random(2)
    series = {f"i{k}": (k % 5, [draw.choice([None, float(draw.randrange(20))]) for _ in range(n)]) for k, n in enumerate([1, 3, 4, 5, 8, 21, 40])}
    got = {(r["item"], r["end"]): r["level"] for r in item_levels(packed_of(spark, series), "item", prior=3.0).collect()}
    assert len(got) == sum(len(v) for _, v in series.values())
    for k, (start, values) in series.items():
        for end in range(1, len(values) + 1):
            own = [v for v in values[:end] if v is not None]
            every = [v for s, vs in series.values() for i, v in enumerate(vs) if s + i <= start + end - 1 and v is not None]
            total = sum(every) / len(every) if every else 0.0
            assert got[k, end] == pytest.approx((sum(own) + 3 * total) / (len(own) + 3))


def test_no_later_value_enters_a_training_row(spark):
    """Values behind a day change only the labels of windows that end before it."""
    draw = random.Random(3)
    series = {f"i{k}": (k, [float(draw.randrange(1, 20)) for _ in range(60)]) for k in range(4)}
    later = {k: (s, v[: 40 - s] + [x * 100 for x in v[40 - s :]]) for k, (s, v) in series.items()}
    inputs = [*forecast.FEATURES, forecast.LEVEL]
    before, after = (
        training_rows(packed_of(spark, x), "item", 14, 5, prior=5.0).groupBy("item", *inputs).count().collect() for x in (series, later)
    )
    same = set(map(tuple, before)) & set(map(tuple, after))
    # 40 - s - 13 windows of five steps end before the change in each series.
    assert len(same) >= sum((27 - s) * 5 for s, _ in series.values())
    plain = training_rows(packed_of(spark, series), "item", 14, 5)
    assert plain.columns == ["item", *forecast.FEATURES, "label"]


def test_forest_forecasts_tell_items_apart(spark):
    # Contexts of zeros look alike; only the item's level knows how much comes on its rare days.
    rows = spark.range(6).selectExpr("concat('i', id) AS item", "id", "explode(sequence(0, 299)) AS d")
    rows = rows.selectExpr("item", "CAST(timestamp'2023-01-01' + make_dt_interval(d) AS timestamp) AS ts", "IF(pmod(xxhash64(item, d), 4) = 0, 10.0D * (CAST(substr(item, 2) AS INT) + 1), 1.0D) AS units")
    packed = pack_series(rows.filter("ts < timestamp'2023-10-14'"), "item", "ts", "units")
    model = fit_forest_forecaster(packed, "item", context=14, horizon=14, stride=3, trees=5)
    none = spark.createDataFrame([("none", [None] * 20)], "item string, target array<double>").select("item", F.to_timestamp(F.lit("2023-01-01")).alias("start"), "target")
    records = {r["item"]: r for r in score_forest_forecaster(model, packed.unionByName(none), "item", QUANTILES).collect()}
    assert records["none"]["quantiles"] is None and records["none"]["error"]
    highs = [np.mean(records[f"i{k}"]["quantiles"]["0.9"]) for k in range(6)]
    assert len(records) == 7 and highs[5] > 2 * highs[0]
    for k in range(6):
        low, mid, high = (np.array(records[f"i{k}"]["quantiles"][str(q)]) for q in QUANTILES)
        assert len(mid) == 14 and (low <= mid).all() and (mid <= high).all()
    actuals = pack_series(rows.filter("ts >= timestamp'2023-10-14'"), "item", "ts", "units")
    pairs = align_forecast(actuals, score_forest_forecaster(model, packed, "item", [0.9]), "item", 14, "0.9")
    assert pairs.agg(F.avg((F.col("target") <= F.col("predictions")).cast("double"))).first()[0] > 0.75
