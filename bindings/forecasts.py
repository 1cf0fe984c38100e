"""Forecast candidates on mean-resampled supplier series, the last 28 bins held out."""

from pyspark.sql import functions as F

from stockweave.operators.autoregression import autoregression
from stockweave.operators.backtest import rolling_cuts, window_history, window_scores
from stockweave.operators.forecast import (
    auto_forecast,
    backtest_rows,
    candidates,
    fit_forecaster,
    forecast_rows,
    history,
    hold_out,
    item_levels,
    pack_forecasts,
    score_forecaster,
    seasonal_naive,
    smoothing,
    training_rows,
    weighted_history,
)
from stockweave.operators.metrics import forecast_metrics, regression_metrics, seasonal_scale
from stockweave.operators.pack import align_forecast, ordered_values, pack_series
from stockweave.operators.quantile_forest import (
    fit_forest_forecaster,
    leaf_quantiles,
    leaf_sketch,
    merge_sketches,
    score_forest_forecaster,
)
from stockweave.operators.registry import top_model
from stockweave.operators.series import regularize, to_bins
from stockweave.operators.states import GRID, fitted_states, states_path
from stockweave.operators.trend import fitted_trend, trend_path
from stockweave.session import materialize

from .common import HOLDOUT, SUPPLY, day, grid_sql, line_sql, query, r6, supply, table

HORIZON = 28


def held_out(spark, sf_dir):
    bins = to_bins(supply(spark, sf_dir), "item", "ts", {"units": "mean"})
    return regularize(bins, "item", {"units": "linear"}, cut=hold_out(HORIZON))


def supplier_history(spark, sf_dir):
    return history(held_out(spark, sf_dir), "item", "ts", "units")


_SERIES = f"""{grid_sql(SUPPLY, 'avg')}, {line_sql(HOLDOUT)},
train AS (SELECT item, d, v, pos, hi - 27 AS cut, CAST(hi - 27 - d - 1 AS INTEGER) AS age FROM series WHERE d <= hi - 28),
actual AS (SELECT item, d, v, CAST(d - (hi - 27) + 1 AS INTEGER) AS step FROM series WHERE d > hi - 28),
steps AS (SELECT CAST(unnest(generate_series(1, 28)) AS INTEGER) AS step)"""

_NAIVE = """
naive AS (
  SELECT t.item, s.step, t.v AS p, t.cut FROM train t JOIN steps s ON t.age = 6 - (s.step - 1) % 7
)"""
_WEIGHTED = """
weights AS (SELECT item, v, pos, cut, exp(-age * 0.1::DOUBLE) AS w FROM train WHERE age < 28 AND v IS NOT NULL),
cum AS (
  SELECT *, sum(w) OVER (PARTITION BY item ORDER BY v, pos ROWS UNBOUNDED PRECEDING) AS c,
         sum(w) OVER (PARTITION BY item) AS t FROM weights
),
flat_w AS (SELECT item, cut, min(v) AS p FROM cum WHERE c >= 0.5::DOUBLE * t GROUP BY 1, 2)"""
_SMOOTH = """
flat_s AS (
  SELECT item, cut, sum(CASE WHEN pos = 0 THEN pow(0.7::DOUBLE, age) ELSE 0.3::DOUBLE * pow(0.7::DOUBLE, age) END * v) AS p
  FROM train GROUP BY 1, 2
)"""
_SCALE = """
scales AS (
  SELECT item, avg(abs(v - l)) AS scale
  FROM (SELECT item, v, lag(v, 7) OVER (PARTITION BY item ORDER BY d) AS l FROM train) GROUP BY 1
)"""
_ALL = f"""{_SERIES}, {_NAIVE}, {_WEIGHTED}, {_SMOOTH}, {_SCALE},
forecasts AS (
  SELECT 'seasonal_naive' AS model, item, step, p FROM naive
  UNION ALL SELECT 'weighted_history', item, step, p FROM flat_w, steps
  UNION ALL SELECT 'smoothing', item, step, p FROM flat_s, steps
),
scored AS (
  SELECT f.model, f.item, f.step, a.v AS y, f.p, s.scale FROM forecasts f
  JOIN actual a ON a.item = f.item AND a.step = f.step JOIN scales s ON s.item = f.item
  WHERE a.v IS NOT NULL AND f.p IS NOT NULL
),
scores AS (
  SELECT model, count(*) AS item_count, sum(abs(y - p)) / sum(abs(y)) AS wape, sqrt(avg((y - p) * (y - p))) AS rmse,
         avg(abs(y - p) / scale) AS mase, avg(abs((y - p) / y)) AS mape,
         avg(CASE WHEN y = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS zero_share
  FROM scored GROUP BY 1
)"""

_SCORES = (
    "round(wape, 6) AS wape, round(rmse, 6) AS rmse, round(mase, 6) AS mase, round(mape, 6) AS mape"
)


def rounded(df, *also):
    return df.select("model", *also, "item_count", *[r6(c).alias(c) for c in ("wape", "rmse", "mase", "mape")])


@query(
    "seasonal_naive",
    f"WITH {_SERIES}, {_NAIVE} SELECT item, step, CAST(cut + (step - 1) AS DATE) AS d, round(p, 9) AS prediction FROM naive",
)
def naive(spark, sf_dir):
    return _rows(spark, sf_dir, {"seasonal_naive": seasonal_naive(HORIZON)})


@query(
    "weighted_history_forecast",
    f"WITH {_SERIES}, {_WEIGHTED} SELECT item, step, CAST(cut + (step - 1) AS DATE) AS d, round(p, 9) AS prediction FROM flat_w, steps",
)
def weighted(spark, sf_dir):
    return _rows(spark, sf_dir, {"weighted_history": weighted_history(HORIZON)})


@query(
    "smoothing_forecast",
    f"WITH {_SERIES}, {_SMOOTH} SELECT item, step, CAST(cut + (step - 1) AS DATE) AS d, round(p, 9) AS prediction FROM flat_s, steps",
)
def smoothed(spark, sf_dir):
    return _rows(spark, sf_dir, {"smoothing": smoothing(HORIZON)})


def _rows(spark, sf_dir, models):
    out = forecast_rows(supplier_history(spark, sf_dir), "item", models)
    return out.select("item", "step", day("ts"), F.round("prediction", 9).alias("prediction"))


@query(
    "align_forecast",
    f"""WITH {_SERIES}, {_NAIVE},
truth AS MATERIALIZED (SELECT item, step, d, v FROM actual),
path AS MATERIALIZED (SELECT item, step, p FROM naive)
SELECT item, d AS start, round(v, 9) AS target, round(p, 9) AS predictions FROM truth JOIN path USING (item, step)""",
)
def aligned(spark, sf_dir):
    regular = held_out(spark, sf_dir)
    actuals = pack_series(regular.filter("pos >= cut_pos"), "item", "ts", "units")
    hist = history(regular, "item", "ts", "units")
    rows = forecast_rows(hist, "item", {"seasonal_naive": seasonal_naive(HORIZON)})
    out = align_forecast(actuals, pack_forecasts(rows, "item"), "item", HORIZON)
    return out.select(
        "item",
        F.to_date("start").alias("start"),
        F.round("target", 9).alias("target"),
        F.round("predictions", 9).alias("predictions"),
    )


@query(
    "forecast_metrics",
    f"WITH {_ALL} SELECT model, item_count, {_SCORES}, zero_share FROM scores WHERE model = 'seasonal_naive'",
)
def naive_metrics(spark, sf_dir):
    regular = held_out(spark, sf_dir)
    hist = history(regular, "item", "ts", "units")
    rows = backtest_rows(hist, "item", {"seasonal_naive": seasonal_naive(HORIZON)})
    scores = forecast_metrics(rows, by=["model"])
    return rounded(scores).join(scores.select("model", "zero_share"), "model")


@query("seasonal_scale", f"WITH {_SERIES}, {_SCALE} SELECT item, round(scale, 6) AS scale FROM scales")
def scale(spark, sf_dir):
    train = held_out(spark, sf_dir).filter("pos < cut_pos")
    return seasonal_scale(train, "item", "units").select("item", r6("scale").alias("scale"))


WINDOWS, STRIDE = 4, 14
# Overlapping windows of 28 bins; each interpolates both sides of its own cut.
_WINDOWS = f"""{grid_sql(SUPPLY, 'avg')},
cuts AS (SELECT CAST(unnest(generate_series(0, {WINDOWS - 1})) AS INTEGER) AS w),
sides AS (SELECT raw.*, w, hi - (27 + {STRIDE} * w) AS cut FROM raw, cuts WHERE hi - (27 + {STRIDE} * w) > lo),
near AS (
  SELECT *,
    last_value(v IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER p AS pd,
    first_value(v IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER n AS nd
  FROM sides
  WINDOW p AS (PARTITION BY item, w, d >= cut ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY item, w, d >= cut ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
lined AS (
  SELECT item, w, d, lo, cut, pos, CAST(cut - d - 1 AS INTEGER) AS age,
    CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv ELSE (nv - pv) / (nd - pd) * (d - pd) + pv END AS v
  FROM near WHERE d < cut + 28
),
train AS (SELECT * FROM lined WHERE d < cut),
actual AS (SELECT item, w, v, CAST(d - cut + 1 AS INTEGER) AS step FROM lined WHERE d >= cut),
steps AS (SELECT CAST(unnest(generate_series(1, 28)) AS INTEGER) AS step),
weights AS (SELECT item, w, v, pos, exp(-age * 0.1::DOUBLE) AS x FROM train WHERE age < 28 AND v IS NOT NULL),
cum AS (
  SELECT *, sum(x) OVER (PARTITION BY item, w ORDER BY v, pos ROWS UNBOUNDED PRECEDING) AS c, sum(x) OVER (PARTITION BY item, w) AS t
  FROM weights
),
forecasts AS (
  SELECT 'seasonal_naive' AS model, t.item, t.w, s.step, t.v AS p FROM train t JOIN steps s ON t.age = 6 - (s.step - 1) % 7
  WHERE t.cut - t.lo >= 7
  UNION ALL SELECT 'weighted_history', item, w, step, p
  FROM (SELECT item, w, min(v) AS p FROM cum WHERE c >= 0.5::DOUBLE * t GROUP BY 1, 2), steps
  UNION ALL SELECT 'smoothing', item, w, step, p
  FROM (SELECT item, w, sum(CASE WHEN pos = 0 THEN pow(0.7::DOUBLE, age) ELSE 0.3::DOUBLE * pow(0.7::DOUBLE, age) END * v) AS p
        FROM train GROUP BY 1, 2), steps
),
scales AS (
  SELECT item, w, avg(abs(v - l)) AS scale
  FROM (SELECT item, w, v, lag(v, 7) OVER (PARTITION BY item, w ORDER BY d) AS l FROM train) GROUP BY 1, 2
),
scored AS (
  SELECT f.model, f.w, a.v AS y, f.p, s.scale, count(f.p) OVER (PARTITION BY f.item, f.w, f.step) AS filled
  FROM forecasts f JOIN actual a ON a.item = f.item AND a.w = f.w AND a.step = f.step
  JOIN scales s ON s.item = f.item AND s.w = f.w
)
SELECT model, w AS "window", count(*) AS item_count, round(sum(abs(y - p)) / sum(abs(y)), 6) AS wape,
       round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p) / scale), 6) AS mase,
       round(avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END), 6) AS mape
FROM scored WHERE filled = 3 AND y IS NOT NULL GROUP BY GROUPING SETS ((model, w), (model))"""


@query("backtest_windows", f"WITH {_WINDOWS}")
def backtest_windows(spark, sf_dir):
    """Scores of each candidate per window, and over all windows (window null)."""
    bins = to_bins(supply(spark, sf_dir), "item", "ts", {"units": "mean"})
    regular = regularize(bins, "item", {"units": "linear"}, cut=rolling_cuts(WINDOWS, HORIZON, STRIDE))
    hist = materialize(window_history(regular, "item", "ts", "units", WINDOWS))
    total, per_window = window_scores(hist, "item", candidates(HORIZON))
    total = total.withColumn("window", F.lit(None).cast("int"))
    return rounded(total.unionByName(per_window), "window")


@query("auto_forecast", f"WITH {_ALL} SELECT model, item_count, {_SCORES} FROM scores")
def auto(spark, sf_dir):
    scores, _ = auto_forecast(supplier_history(spark, sf_dir), "item", candidates(HORIZON))
    return rounded(scores)


@query("top_model", f"WITH {_ALL} SELECT model, item_count, {_SCORES} FROM scores ORDER BY scores.wape LIMIT 1")
def best(spark, sf_dir):
    scores, _ = auto_forecast(supplier_history(spark, sf_dir), "item", candidates(HORIZON))
    return rounded(top_model(scores, "wape"))


def _quantile_records(spark, sf_dir):
    """Forecast records of one model over all suppliers, and the packed held-out actuals."""
    n_train = F.max("cut_pos").alias("n_train")
    series = held_out(spark, sf_dir).groupBy("item").agg(
        F.min("ts").alias("first"), n_train, ordered_values(F.col("pos"), F.col("units")).alias("target")
    )
    packed = materialize(series)
    train = packed.select("item", F.slice("target", F.lit(1), F.col("n_train")).alias("target"))
    model = fit_forecaster(train, "item", quantiles=(0.5, 0.9))
    actuals = packed.select(
        "item",
        F.timestamp_add("DAY", F.col("n_train"), F.col("first")).alias("start"),
        F.slice("target", F.col("n_train") + 1, HORIZON).alias("target"),
    )
    return score_forecaster(model, train, "item"), actuals


@query(
    "forecaster_training_rows",
    f"""WITH {_SERIES},
ends AS (
  SELECT item, pos, v AS last_value, avg(abs(v)) OVER w AS mean, avg(v) OVER w AS typical, count(v) OVER w / 28.0::DOUBLE AS known,
         avg(v) OVER (PARTITION BY item ORDER BY pos ROWS 6 PRECEDING) AS week, count(*) OVER (PARTITION BY item) AS n
  FROM train WINDOW w AS (PARTITION BY item ORDER BY pos ROWS 27 PRECEDING)
),
windows AS (
  SELECT *, CASE WHEN mean > 0 THEN mean ELSE 1.0::DOUBLE END AS scale, coalesce(typical, 0) AS usual FROM ends
  WHERE pos + 1 >= least(28, ceil(n / 2)) AND pos + 1 <= greatest(n - 28, least(28, ceil(n / 2)))
)
SELECT w.item, step, count(*) AS n, round(sum(y.v / scale), 4) AS label, round(sum(coalesce(a.v, usual) / scale), 4) AS week_1,
       round(sum(coalesce(b.v, usual) / scale), 4) AS week_2, round(sum(coalesce(week, usual) / scale), 4) AS recent_mean,
       round(sum(coalesce(w.last_value, usual) / scale), 4) AS last_value, round(sum(known), 4) AS known
FROM windows w CROSS JOIN steps JOIN train y ON y.item = w.item AND y.pos = w.pos + step
LEFT JOIN train a ON a.item = w.item AND a.pos = w.pos - 6 + (step - 1) % 7
LEFT JOIN train b ON b.item = w.item AND b.pos = w.pos - 13 + (step - 1) % 7
WHERE y.v IS NOT NULL GROUP BY 1, 2""",
)
def forecaster_rows(spark, sf_dir):
    """Inputs and labels of the model over all suppliers, summed per item and step."""
    train = pack_series(held_out(spark, sf_dir).filter("pos < cut_pos"), "item", "ts", "units")
    names = ("label", "week_1", "week_2", "recent_mean", "last_value", "known")
    return training_rows(train, "item").groupBy("item", "step").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.sum(c), 4).alias(c) for c in names]
    )


@query(
    "global_quantile_forecast",
    f"""WITH {_SERIES}
SELECT item, d AS start, round(v, 9) AS target, true AS ordered FROM actual""",
)
def quantile_forecast(spark, sf_dir):
    """Each held-out bin has a median and an upper path in this order, beside its actual."""
    records, actuals = _quantile_records(spark, sf_dir)
    low = align_forecast(actuals, records, "item", HORIZON, "0.5")
    high = align_forecast(actuals, records, "item", HORIZON, "0.9")
    both = low.join(
        high.select("item", "start", F.col("predictions").alias("upper")), ["item", "start"]
    )
    return both.select(
        "item",
        F.to_date("start").alias("start"),
        F.round("target", 9).alias("target"),
        (F.col("predictions") <= F.col("upper")).alias("ordered"),
    )


@query("quantile_forecast_metrics")
def quantile_metrics(spark, sf_dir):
    """Regression metrics of the median path over all suppliers."""
    records, actuals = _quantile_records(spark, sf_dir)
    return regression_metrics(align_forecast(actuals, records, "item", HORIZON, "0.5"))


def _packed_train(spark, sf_dir):
    """Packed training bins of all suppliers with the start of each series, and the held-out actuals."""
    series = held_out(spark, sf_dir).groupBy("item").agg(
        F.min("ts").alias("start"), F.max("cut_pos").alias("n_train"), ordered_values(F.col("pos"), F.col("units")).alias("target")
    )
    packed = materialize(series)
    actuals = packed.select(
        "item",
        F.timestamp_add("DAY", F.col("n_train"), F.col("start")).alias("start"),
        F.slice("target", F.col("n_train") + 1, HORIZON).alias("target"),
    )
    return packed.select("item", "start", F.slice("target", F.lit(1), F.col("n_train")).alias("target")), actuals


@query(
    "item_levels",
    f"""WITH {_SERIES},
days AS (SELECT d, sum(v) AS x, count(v) AS k FROM train GROUP BY d),
totals AS (SELECT d, coalesce(sum(x) OVER w / nullif(sum(k) OVER w, 0), 0) AS every FROM days WINDOW w AS (ORDER BY d))
SELECT t.item, CAST(pos + 1 AS INTEGER) AS "end", t.d AS last,
       round((coalesce(sum(v) OVER w, 0) + 10 * every) / (count(v) OVER w + 10), 6) AS level
FROM train t JOIN totals USING (d) WINDOW w AS (PARTITION BY item ORDER BY pos)""",
)
def levels(spark, sf_dir):
    """What an item's code stands for after each bin."""
    packed, _ = _packed_train(spark, sf_dir)
    out = item_levels(packed, "item")
    return out.select("item", "end", F.to_date("last").alias("last"), F.round("level", 6).alias("level"))


_LEAVES = ["CAST(floor(l_quantity / 10) AS INTEGER)", "CAST(round(l_discount * 100) AS INTEGER)", "CAST(round(l_tax * 100) AS INTEGER)"]


@query(
    "leaf_quantiles",
    f"""
WITH members AS (SELECT [{', '.join(_LEAVES)}] AS leaves, CAST(least(floor(l_extendedprice / 1000), 99) AS INTEGER) AS cell FROM lineitem),
each AS (SELECT unnest([0, 1, 2]) AS tree, unnest(leaves) AS leaf, cell FROM members),
shares AS (
  SELECT tree, leaf, cell, count(*) / sum(count(*)) OVER (PARTITION BY tree, leaf)::DOUBLE AS share FROM each GROUP BY tree, leaf, cell
),
rows AS (SELECT DISTINCT leaves, CAST(leaves AS VARCHAR) AS id FROM members),
mixed AS (
  SELECT id, cell, sum(share) / 3 AS share
  FROM (SELECT id, unnest([0, 1, 2]) AS tree, unnest(leaves) AS leaf FROM rows) JOIN shares USING (tree, leaf) GROUP BY id, cell
),
ends AS (SELECT *, sum(share) OVER (PARTITION BY id ORDER BY cell) AS upto FROM mixed)
SELECT replace(id, ', ', ',') AS id, min(cell) FILTER (upto >= 0.1 - 1e-9) AS q10, min(cell) FILTER (upto >= 0.5 - 1e-9) AS q50,
       min(cell) FILTER (upto >= 0.9 - 1e-9) AS q90
FROM ends GROUP BY id""",
)
def given_leaves(spark, sf_dir):
    """Quantiles of prices, in thousands, from three given trees; the sketch is merged from two halves."""
    leaves = F.array(*[F.expr(x) for x in _LEAVES])
    cell = F.least(F.floor(F.col("l_extendedprice") / 1000), F.lit(99)).cast("int")
    members = table(spark, sf_dir, "lineitem").select(leaves.alias("leaves"), cell.alias("cell"), "l_orderkey")
    halves = [leaf_sketch(members.filter(F.col("l_orderkey") % 2 == k)) for k in (0, 1)]
    rows = members.select("leaves", F.concat(F.lit("["), F.array_join("leaves", ","), F.lit("]")).alias("id")).distinct()
    out = leaf_quantiles(rows, merge_sketches(*halves), ["id"], [0.1, 0.5, 0.9])
    return out.select("id", *[F.col("cells")[i].alias(f"q{q}") for i, q in enumerate((10, 50, 90))])


@query("quantile_forest_coverage")
def forest_coverage(spark, sf_dir):
    """Share of held-out bins at or below each quantile of the forest, and the error of its median."""
    packed, actuals = _packed_train(spark, sf_dir)
    model = fit_forest_forecaster(packed, "item")
    records = materialize(score_forest_forecaster(model, packed, "item"))
    out = None
    for q in ("0.1", "0.5", "0.9"):
        pairs = align_forecast(actuals, records, "item", HORIZON, q)
        below = F.avg((F.col("target") <= F.col("predictions")).cast("double")).alias("covered")
        row = pairs.agg(F.count("target").alias("n_bins"), below, F.sqrt(F.avg((F.col("target") - F.col("predictions")) ** 2)).alias("rmse"))
        row = row.withColumn("quantile", F.lit(float(q)))
        out = row if out is None else out.unionByName(row)
    return out


_GRID = ", ".join(f"({i}, {a}, {b}, {g})" for i, (a, b, g) in enumerate(GRID))


@query(
    "states_forecast",
    f"""WITH RECURSIVE {_SERIES},
packed AS MATERIALIZED (SELECT item, max(d) AS last, list(v ORDER BY pos) AS y FROM train GROUP BY item),
grid_of AS (SELECT i AS g, a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c FROM (VALUES {_GRID}) x(i, a, b, c)),
folds AS (
  SELECT item, g, a, b, c, 0 AS i, CAST(NULL AS DOUBLE) AS l, 0::DOUBLE AS t, [0, 0, 0, 0, 0, 0, 0]::DOUBLE[] AS s, 0::DOUBLE AS q, 0 AS n
  FROM packed, grid_of
  UNION ALL
  SELECT item, g, a, b, c, i + 1, CASE WHEN l IS NULL THEN x WHEN e IS NULL THEN l + t ELSE l + t + a * e END,
         CASE WHEN e IS NULL THEN t ELSE t + b * e END, list_append(s[2:], CASE WHEN e IS NULL THEN s[1] ELSE s[1] + c * e END),
         q + coalesce(e * e, 0), n + CASE WHEN e IS NULL THEN 0 ELSE 1 END
  FROM (SELECT f.*, y[i + 1] AS x, y[i + 1] - (l + t + s[1]) AS e FROM folds f JOIN packed USING (item) WHERE i < len(y))
),
best AS (
  SELECT f.*, last, row_number() OVER (PARTITION BY item ORDER BY n = 0, q / nullif(n, 0), g) AS place
  FROM folds f JOIN packed USING (item) WHERE i = len(y)
)
SELECT item, step, CAST(last + step AS DATE) AS d, a AS alpha, b AS beta, c AS gamma, round(l + step * t + s[(step - 1) % 7 + 1], 6) AS prediction
FROM best, steps WHERE place = 1 AND l IS NOT NULL""",
)
def states(spark, sf_dir):
    """Level, trend and season of each supplier, folded in order under every setting of the grid."""
    packed, _ = _packed_train(spark, sf_dir)
    fitted = fitted_states(packed, "item").join(packed.select("item", "start", F.size("target").alias("n")), "item")
    out = fitted.select("item", "start", "n", "alpha", "beta", "gamma", F.posexplode(states_path(HORIZON)).alias("i", "p"))
    return out.select(
        "item",
        (F.col("i") + 1).alias("step"),
        F.to_date(F.timestamp_add("DAY", F.col("n") + F.col("i"), F.col("start"))).alias("d"),
        "alpha",
        "beta",
        "gamma",
        F.round("p", 6).alias("prediction"),
    )


def _determinant(rows):
    """Text of a determinant by expansion along the first row."""
    if len(rows) == 1:
        return rows[0][0]
    terms = [f"{'-' if j % 2 else '+'} {x} * ({_determinant([r[:j] + r[j + 1 :] for r in rows[1:]])})" for j, x in enumerate(rows[0])]
    return " ".join(terms)


def _normal_sql(inputs, y, rows):
    """Normal equations with their ridge, solved by determinants: item and s0, s1, …"""
    k = len(inputs)
    known = " AND ".join(f"{x} IS NOT NULL" for x in [*inputs, y])
    sums = [f"sum({a} * {b}) AS a{i}_{j}" for i, a in enumerate(inputs) for j, b in enumerate([*inputs, y]) if j >= i]
    cell = lambda i, j: f"(a{i}_{i} + ridge)" if i == j else f"a{min(i, j)}_{max(i, j)}"
    matrix = [[cell(i, j) for j in range(k)] for i in range(k)]
    with_y = lambda c: [[f"a{i}_{k}" if j == c else x for j, x in enumerate(row)] for i, row in enumerate(matrix)]
    ridge = " + ".join(f"a{i}_{i}" for i in range(k))
    solutions = ", ".join(f"({_determinant(with_y(c))}) / ({_determinant(matrix)}) AS s{c}" for c in range(k))
    return f"""SELECT item, {solutions} FROM (
  SELECT *, ({ridge}) / {k} * 1e-6 AS ridge FROM (SELECT item, {', '.join(sums)} FROM {rows} WHERE {known} GROUP BY item))"""


@query(
    "autoregression",
    f"""WITH {_SERIES},
lagged AS (SELECT item, pos, v, 1.0::DOUBLE AS one, lag(v, 1) OVER w AS v1, lag(v, 7) OVER w AS v7 FROM train WINDOW w AS (PARTITION BY item ORDER BY pos)),
first AS ({_normal_sql(['one', 'v1', 'v7'], 'v', 'lagged')}),
errors AS (SELECT l.*, v - (s0 + s1 * v1 + s2 * v7) AS e FROM lagged l JOIN first USING (item)),
rows2 AS (SELECT *, lag(e, 1) OVER (PARTITION BY item ORDER BY pos) AS e1 FROM errors),
second AS ({_normal_sql(['one', 'v1', 'v7', 'e1'], 'v', 'rows2')})
SELECT item, round(s0, 4) AS constant, round(s1, 5) AS lag_1, round(s2, 5) AS lag_7, round(s3, 5) AS error_1 FROM second""",
)
def lags(spark, sf_dir):
    """Coefficients of each supplier's second stage."""
    out = autoregression(held_out(spark, sf_dir), "item", "units")
    c = lambda i, digits: F.round(F.get("coefficients", F.lit(i)), digits)
    return out.select("item", c(0, 4).alias("constant"), c(1, 5).alias("lag_1"), c(2, 5).alias("lag_7"), c(3, 5).alias("error_1"))


@query(
    "trend_forecast",
    f"""WITH {_SERIES},
terms AS (
  SELECT item, v, 1.0::DOUBLE AS one, pos / (cut - lo)::DOUBLE AS t, greatest(pos / (cut - lo)::DOUBLE - 0.4, 0) AS hinge,
         sin(pos * (2 * pi() / 7)) AS wave, cos(pos * (2 * pi() / 7)) AS turn
  FROM (SELECT tr.*, min(d) OVER (PARTITION BY item) AS lo FROM train tr)
),
solution AS ({_normal_sql(['one', 't', 'hinge', 'wave', 'turn'], 'v', 'terms')}),
sizes AS (SELECT item, max(pos) + 1 AS n, count(v) AS known, max_by(v, pos) AS last FROM train GROUP BY item)
SELECT item, step, round(CASE WHEN known >= 10 THEN
  s0 + s1 * (n + step - 1) / n::DOUBLE + s2 * ((n + step - 1) / n::DOUBLE - 0.4) + s3 * sin((n + step - 1) * (2 * pi() / 7)) + s4 * cos((n + step - 1) * (2 * pi() / 7))
  ELSE last END, 4) AS prediction
FROM solution JOIN sizes USING (item), steps""",
)
def trend(spark, sf_dir):
    """One change point and one wave a week, carried on behind the cut."""
    fitted = fitted_trend(held_out(spark, sf_dir), "item", "units", points=1, order=1)
    path = trend_path(HORIZON, points=1, order=1)
    out = fitted.select("item", F.posexplode(path).alias("i", "p"))
    return out.select("item", (F.col("i") + 1).alias("step"), F.round("p", 4).alias("prediction"))
