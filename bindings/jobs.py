"""The five composite jobs end to end."""

from dataclasses import replace

from pyspark.sql import functions as F

from stockweave.config import AutoForecastConfig, SeriesConfig, TabularConfig
from stockweave.operators.encode import fit_labels
from stockweave.operators.quality import ConstraintViolation
from stockweave.operators.registry import approve_model, read_registry
from stockweave.plans.auto_forecast_job import run_auto_forecast, target_dataset
from stockweave.plans.series_jobs import (
    approved_series,
    check_series_drift,
    context_part,
    drift_set,
    publish_series,
    score_series_drift,
    train_part,
    train_series,
    training_set,
    validation_part,
)
from stockweave.plans.tabular_jobs import (
    approved_tabular,
    check_tabular_drift,
    drift_rows,
    finish_tabular_drift,
    publish_tabular,
    train_tabular,
    training_rows,
)
from stockweave.session import scratch_path
from stockweave.sources.reports import json_metric, read_report
from stockweave.sources.tables import captured

from .common import VISITS, grid_sql, line_sql, query, r6, table, visits
from .forecasts import rounded

CREATED = "2024-01-01"
APPROVED_ON = "2024-02-01"


def _retail(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("item"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("units"),
        F.when(F.col("l_returnflag") == "R", "Manufacturing")
        .otherwise(F.col("l_returnflag"))
        .alias("distributor_view"),
        F.when(F.col("l_linestatus") == "O", "DAILY").otherwise("WEEKLY").alias("period"),
    )


def _ads(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_discount") > 0.05)
    return lines.select(
        F.col("l_suppkey").alias("item"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_linenumber").cast("double").alias("ads_units"),
    )


_CLEAN = """
views AS (
  SELECT l_suppkey AS item, CAST(l_shipdate AS DATE) AS d, l_quantity AS units, l_returnflag AS view, l_linestatus AS period,
         min(l_returnflag) OVER k = max(l_returnflag) OVER k AS one
  FROM lineitem WINDOW k AS (PARTITION BY l_suppkey, l_shipdate)
),
retail AS (SELECT item, d, sum(units) AS v FROM views WHERE (one OR view = 'R') AND period = 'O' GROUP BY 1, 2),
ads AS (
  SELECT l_suppkey AS item, CAST(l_shipdate AS DATE) AS d, CAST(sum(l_linenumber) AS DOUBLE) AS v
  FROM lineitem WHERE l_discount > 0.05 GROUP BY 1, 2
),
span AS (SELECT item, min(d) AS lo, max(d) AS hi FROM retail GROUP BY 1 HAVING max(d) - min(d) + 1 >= 29),
codes AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS cat FROM span),
grid AS (SELECT item, lo, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
series AS (
  SELECT g.item, g.d, g.d - g.lo AS pos, CAST(floor((g.hi - g.lo + 1) * 0.85::DOUBLE) AS INTEGER) AS n_train,
         coalesce(r.v, 0) + coalesce(a.v, 0) AS v
  FROM grid g LEFT JOIN retail r ON g.item = r.item AND g.d = r.d LEFT JOIN ads a ON g.item = a.item AND g.d = a.d
)"""


@query(
    "series_training_set",
    f"""WITH {_CLEAN}
SELECT s.item, cat, CAST(min(d) AS DATE) AS start, min(CASE WHEN pos >= n_train THEN d END) AS validation_start, n_train,
       CAST(count(*) FILTER (pos >= n_train) AS INTEGER) AS n_validation,
       sum(CASE WHEN pos < n_train THEN v ELSE 0 END) AS train_units, sum(CASE WHEN pos >= n_train THEN v ELSE 0 END) AS validation_units,
       sum(CASE WHEN pos < n_train AND pos >= n_train - 28 THEN v ELSE 0 END) AS context_units
FROM series s JOIN codes c ON s.item = c.item GROUP BY s.item, cat, n_train""",
)
def series_training_set(spark, sf_dir):
    """Everything before the model: preference, period, ads, grid, history, codes, split, context."""
    cfg = SeriesConfig()
    packed, _ = training_set(_retail(spark, sf_dir), _ads(spark, sf_dir), cfg)
    train, validation = train_part(packed, cfg), validation_part(packed, cfg)
    units = lambda name: F.aggregate("target", F.lit(0.0), lambda a, x: a + x).alias(name)
    return (
        packed.select(
            "item",
            "cat",
            F.to_date("start").alias("start"),
            F.to_date("validation_start").alias("validation_start"),
            "n_train",
        )
        .join(train.select("item", units("train_units")), "item")
        .join(
            validation.select("item", F.size("target").alias("n_validation"), units("validation_units")),
            "item",
        )
        .join(context_part(train, cfg).select("item", units("context_units")), "item")
    )


_FIRST = "l_shipdate < TIMESTAMP '2000-01-01'"


@query(
    "series_drift_set",
    f"""WITH codes AS (
  SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS cat
  FROM (SELECT DISTINCT l_suppkey AS item FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-10')
),
{grid_sql("SELECT l_suppkey AS item, l_shipdate AS ts, l_quantity AS units FROM lineitem WHERE NOT " + _FIRST, 'avg')},
counts AS (SELECT d, count(*) AS n FROM raw GROUP BY 1),
cut AS (SELECT min(d) AS c FROM (SELECT d, sum(n) OVER (ORDER BY d) AS u, sum(n) OVER () AS t FROM counts) WHERE u > t // 2),
{line_sql("d >= (SELECT c FROM cut)")},
steps AS (SELECT item, v, d - (SELECT c FROM cut) AS s FROM series)
SELECT t.item, coalesce(cat, 100) AS cat, CAST(count(*) FILTER (s < 0) AS INTEGER) AS n_context,
       CAST(count(*) FILTER (s >= 0) AS INTEGER) AS n_truth,
       round(sum(v) FILTER (s < 0), 6) AS context_units, round(sum(v) FILTER (s >= 0), 6) AS truth_units
FROM steps t LEFT JOIN codes c ON t.item = c.item WHERE s >= -28 AND s < 28
GROUP BY t.item, cat HAVING count(*) FILTER (s < 0) > 0 AND count(*) FILTER (s >= 0) > 0""",
)
def series_drift_set(spark, sf_dir):
    """Contexts and truth of the later observations, codes fitted on the first shipments only."""
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    old = F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz")
    early = F.col("ts") < F.lit("1995-01-10").cast("timestamp_ntz")
    mapping = fit_labels(rows.filter(early), "item")
    contexts, truth = drift_set(rows.filter(~old), mapping, SeriesConfig(how="mean"))
    units = lambda name: r6(
        F.aggregate("target", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    ).alias(name)
    return contexts.select("item", F.size("target").alias("n_context"), units("context_units")).join(
        truth.select("item", "cat", F.size("target").alias("n_truth"), units("truth_units")), "item"
    )


def _published(spark, job, root):
    """What a job left: a registry row exactly if the gate passed, the error of its report."""
    passed = job.gate.first()["passed"]
    reported = json_metric(read_report(spark, f"{root}/reports/evaluation")).first()["value"]
    return {
        "registered_as_gated": F.lit(read_registry(spark, f"{root}/registry").count() == int(passed)),
        "report_matches": F.lit(reported == job.metrics.first()["rmse"]),
    }


def _n_rows(metrics):
    return F.lit(metrics.first()["item_count"]).cast("bigint")


@query(
    "job_series_train",
    f"""WITH {_CLEAN}
SELECT count(DISTINCT item) AS eligible, count(DISTINCT item) AS scored, 0::BIGINT AS rejected,
       count(*) FILTER (pos >= n_train AND pos < n_train + 28) AS n_rows, true AS registered_as_gated, true AS report_matches
FROM series""",
)
def series_train(spark, sf_dir):
    root = scratch_path(spark, "series-train")
    job = train_series(
        _retail(spark, sf_dir), _ads(spark, sf_dir), SeriesConfig(), f"{root}/model", CREATED
    )
    publish_series(job, f"{root}/registry", f"{root}/reports")
    return job.coverage.withColumns({"n_rows": _n_rows(job.metrics), **_published(spark, job, root)})


@query(
    "forecast_coverage",
    f"""WITH {grid_sql(VISITS, 'avg')}, {line_sql()},
parts AS (SELECT item, v, pos, floor(n_bins * 0.85::DOUBLE) AS n_train FROM series WHERE n_bins >= 29)
SELECT count(DISTINCT item) AS eligible, count(DISTINCT item) AS scored, 0::BIGINT AS rejected,
       count(v) FILTER (pos >= n_train AND pos < n_train + 28) AS n_rows FROM parts""",
)
def coverage(spark, sf_dir):
    """Users of few bins are forecast too."""
    rows = visits(spark, sf_dir).select("item", "ts", "units")
    job = train_series(rows, None, SeriesConfig(how="mean"), "models/users", CREATED)
    return job.coverage.withColumn("n_rows", _n_rows(job.metrics))


_LATER = "SELECT l_suppkey AS item, l_shipdate AS ts, l_quantity AS units FROM lineitem WHERE NOT " + _FIRST


@query(
    "job_series_drift",
    f"""WITH {grid_sql(_LATER, 'avg')},
counts AS (SELECT d, count(*) AS n FROM raw GROUP BY 1),
cut AS (SELECT min(d) AS c FROM (SELECT d, sum(n) OVER (ORDER BY d) AS u, sum(n) OVER () AS t FROM counts) WHERE u > t // 2),
{line_sql("d >= (SELECT c FROM cut)")},
steps AS (SELECT item, v, d - (SELECT c FROM cut) AS s FROM series),
items AS (
  SELECT item, count(v) FILTER (s >= 0 AND s < 28) AS n FROM steps
  GROUP BY item HAVING count(*) FILTER (s < 0) > 0 AND count(*) FILTER (s >= 0) > 0
)
SELECT count(*) AS eligible, count(*) AS scored, 0::BIGINT AS rejected, CAST(sum(n) AS BIGINT) AS n_rows,
       true AS failed, true AS rmse_reported FROM items""",
)
def series_drift(spark, sf_dir):
    """The approved model of the years before 2000 meets later units three times as high.

    The baseline comes from another run, over the years it was trained on. The run fails, its reports stay.
    """
    root = scratch_path(spark, "series-drift")
    cfg = SeriesConfig(how="mean", rmse_gate=1000.0)
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    old = F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz")
    job = train_series(rows.filter(old), None, cfg, f"{root}/model", CREATED)
    publish_series(job, f"{root}/registry", f"{root}/reports")
    approve_model(spark, f"{root}/registry", f"{root}/model", APPROVED_ON)
    item_type = rows.schema["item"].dataType.simpleString()
    model, mapping = approved_series(spark, f"{root}/registry", item_type)
    first = score_series_drift(rows.filter(old), mapping, model, cfg)
    check_series_drift(first, f"{root}/baseline", register_baseline=True)
    later = rows.filter(~old).withColumn("units", F.col("units") * 3)
    drift = score_series_drift(later, mapping, model, cfg)
    try:
        check_series_drift(drift, f"{root}/baseline", reports=f"{root}/check")
        failed = False
    except ConstraintViolation:
        failed = True
    found = read_report(spark, f"{root}/check/violations").first()["value"]
    return drift.coverage.withColumns(
        {
            "n_rows": _n_rows(drift.metrics),
            "failed": F.lit(failed),
            "rmse_reported": F.lit('"metric_name":"rmse"' in found),
        }
    )


_FEATURES = ("asin_code", "ad_group_name_code", "targeting_type", "spend", "Cluster", "year", "month")


def _campaign(spark, sf_dir):
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    targeting = (
        F.when(F.col("l_returnflag") == "A", "Automatic targeting")
        .when(F.col("l_returnflag") == "N", "Manual targeting")
        .otherwise("context")
    )
    return joined.select(
        F.col("l_orderkey").alias("row_id"),
        F.col("l_shipdate").alias("date"),
        F.col("p_name").alias("advertised_asin"),
        F.col("p_brand").alias("ad_group_name"),
        targeting.alias("targeting_type"),
        F.when(F.col("l_linestatus") == "O", "ENABLED").otherwise("PAUSED").alias("status"),
        (F.col("l_quantity") * 11).alias("spend"),
        F.col("p_size").alias("closest_cluster"),
        F.col("l_extendedprice").alias("units"),
    )


def _tabular_config(trials: int = 5):
    return TabularConfig("units", _FEATURES, trials=trials)


_ENCODED = """
rows AS (
  SELECT l_orderkey, l_extendedprice AS units, l_shipdate AS date, p_name AS asin, p_brand AS ad_group_name,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS targeting_type, l_quantity * 11 AS spend, p_size AS "Cluster"
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
asins AS (SELECT asin, CAST(row_number() OVER (ORDER BY asin) - 1 AS INTEGER) AS asin_code FROM (SELECT DISTINCT asin FROM rows {first})),
ad_groups AS (
  SELECT ad_group_name, CAST(row_number() OVER (ORDER BY ad_group_name) - 1 AS INTEGER) AS ad_group_name_code
  FROM (SELECT DISTINCT ad_group_name FROM rows {first})
),
coded AS (
  SELECT units, asin_code, ad_group_name_code, targeting_type, spend, "Cluster",
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(concat('0x', substr(md5(concat('1729|', CAST(l_orderkey AS VARCHAR))), 1, 8)) AS BIGINT) % 100 AS bucket
  FROM rows r JOIN asins a ON r.asin = a.asin JOIN ad_groups g ON r.ad_group_name = g.ad_group_name {later}
)"""
_COLUMNS = 'units, asin_code, ad_group_name_code, targeting_type, spend, "Cluster", year, month'


@query(
    "tabular_training_set",
    f"""WITH {_ENCODED.format(first='', later='')}
SELECT {_COLUMNS}, CASE WHEN bucket < 70 THEN 'train' WHEN bucket < 90 THEN 'validation' ELSE 'test' END AS split FROM coded""",
)
def tabular_training_set(spark, sf_dir):
    rows, _ = training_rows(_campaign(spark, sf_dir), _tabular_config(0))
    return rows


_EARLY = "date < TIMESTAMP '1995-02-01'"


@query(
    "tabular_drift_set",
    f"""WITH {_ENCODED.format(first='WHERE ' + _EARLY, later='WHERE NOT ' + _EARLY)}
SELECT {_COLUMNS} FROM coded
WHERE spend < 500 OR NOT (SELECT count(*) FILTER (spend > 500) < 0.2::DOUBLE * count(*) FROM coded)""",
)
def tabular_drift_set(spark, sf_dir):
    """Codes fitted on the first month; later rows with other names drop out, outliers are trimmed."""
    cfg = _tabular_config(0)
    rows = _campaign(spark, sf_dir)
    early = F.col("date") < F.lit("1995-02-01").cast("timestamp_ntz")
    _, mappings = training_rows(rows.filter(early), cfg)
    return drift_rows(rows.filter(~early), cfg, mappings)


@query(
    "job_tabular_train",
    f"""WITH {_ENCODED.format(first='', later='')}
SELECT count(*) AS n_rows, 5::BIGINT AS n_trials, true AS registered_as_gated, true AS report_matches FROM coded WHERE bucket >= 90""",
)
def tabular_train(spark, sf_dir):
    root = scratch_path(spark, "tabular-train")
    job = train_tabular(_campaign(spark, sf_dir), _tabular_config(), f"{root}/model", CREATED)
    publish_tabular(job, f"{root}/registry", f"{root}/reports")
    return job.trials.agg(F.count(F.lit(1)).alias("n_trials")).withColumns(
        {"n_rows": _n_rows(job.metrics), **_published(spark, job, root)}
    )


_BEFORE = "date < TIMESTAMP '2000-01-01'"


@query(
    "job_tabular_drift",
    f"""WITH {_ENCODED.format(first='WHERE ' + _BEFORE, later='WHERE NOT ' + _BEFORE)},
kept AS (SELECT * FROM coded WHERE spend < 500 OR NOT (SELECT count(*) FILTER (spend > 500) < 0.2::DOUBLE * count(*) FROM coded))
SELECT count(*) AS n_rows, count(*) AS n_captured, true AS failed_as_found, true AS reported FROM kept""",
)
def tabular_drift(spark, sf_dir):
    """The approved model of the years before 2000 meets the later rows; unseen codes drop out."""
    root = scratch_path(spark, "tabular-drift")
    cfg = replace(_tabular_config(0), rmse_gate=1e9)
    rows = _campaign(spark, sf_dir)
    old = F.col("date") < F.lit("2000-01-01").cast("timestamp_ntz")
    job = train_tabular(rows.filter(old), cfg, f"{root}/model", CREATED)
    publish_tabular(job, f"{root}/registry", f"{root}/reports")
    approve_model(spark, f"{root}/registry", f"{root}/model", APPROVED_ON)
    base = approved_tabular(spark, f"{root}/registry", cfg)
    drift = check_tabular_drift(
        rows.filter(~old), cfg, base.mappings, base.profile, base.model, base.constraints
    )
    try:
        finish_tabular_drift(drift, f"{root}/check", APPROVED_ON)
        failed = False
    except ConstraintViolation:
        failed = True
    found = not (drift.findings.isEmpty() and drift.violations.isEmpty())
    n_reported = F.json_array_length(F.get_json_object("value", "$.violations"))
    reported = read_report(spark, f"{root}/check/violations").select(n_reported).first()[0]
    rows = captured(spark, f"{root}/check/captured")
    return rows.agg(F.count(F.lit(1)).alias("n_captured")).withColumns(
        {
            "n_rows": _n_rows(drift.metrics),
            "failed_as_found": F.lit(failed == found),
            "reported": F.lit(reported == drift.violations.count()),
        }
    )


_CUTOFF = "DATE '2000-12-31'"
_JOB_SQL = f"""
WITH bins AS (
  SELECT l_suppkey AS item, CAST(l_shipdate AS DATE) AS d, avg(l_quantity) AS v,
         avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS f
  FROM lineitem GROUP BY 1, 2
),
span AS (SELECT item, min(d) AS lo, max(d) AS hi FROM bins GROUP BY 1 HAVING max(d) - min(d) + 1 >= 300),
"""


@query(
    "job_auto_forecast",
    _JOB_SQL
    + f"""
known AS (
  SELECT b.item, min(b.d) AS lo, max(b.d) AS hi FROM bins b JOIN span s ON b.item = s.item
  WHERE b.d < {_CUTOFF} GROUP BY 1
),
raw AS (
  SELECT g.item, g.d, g.lo, g.hi, b.v FROM (
    SELECT item, lo, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM known
  ) g LEFT JOIN bins b ON g.item = b.item AND g.d = b.d
),
near AS (
  SELECT *, d > hi - 24 AS held,
    last_value(v IGNORE NULLS) OVER p AS pv,
    last_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER p AS pd,
    first_value(v IGNORE NULLS) OVER n AS nv,
    first_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER n AS nd
  FROM raw
  WINDOW p AS (PARTITION BY item, d > hi - 24 ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY item, d > hi - 24 ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
series AS (
  SELECT item, d, lo, hi, held,
    CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
         ELSE (nv - pv) / (nd - pd) * (d - pd) + pv END AS v FROM near
),
train AS (SELECT item, d, v, d - lo AS pos, CAST(hi - 24 - d AS INTEGER) AS age FROM series WHERE NOT held),
actual AS (SELECT item, v, CAST(d - hi + 24 AS INTEGER) AS step FROM series WHERE held),
steps AS (SELECT CAST(unnest(generate_series(1, 24)) AS INTEGER) AS step),
cum AS (
  SELECT *, sum(w) OVER (PARTITION BY item ORDER BY v, pos ROWS UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY item) AS t
  FROM (SELECT item, v, pos, exp(-age * 0.1::DOUBLE) AS w FROM train WHERE age < 28 AND v IS NOT NULL)
),
scales AS (
  SELECT item, avg(abs(v - l)) AS scale
  FROM (SELECT item, v, lag(v, 7) OVER (PARTITION BY item ORDER BY d) AS l FROM train) GROUP BY 1
),
forecasts AS (
  SELECT 'seasonal_naive' AS model, t.item, step, v AS p FROM train t JOIN steps s ON t.age = 6 - (s.step - 1) % 7
  UNION ALL SELECT 'weighted_history', item, step, min(v) FROM cum, steps WHERE c >= 0.5::DOUBLE * t GROUP BY 2, 3
  UNION ALL SELECT 'smoothing', item, step,
    sum(CASE WHEN pos = 0 THEN pow(0.7::DOUBLE, age) ELSE 0.3::DOUBLE * pow(0.7::DOUBLE, age) END * v) FROM train, steps GROUP BY 2, 3
)
SELECT model, count(*) AS item_count, round(sum(abs(y - p)) / sum(abs(y)), 6) AS wape, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(avg(abs(y - p) / scale), 6) AS mase, round(avg(abs((y - p) / y)), 6) AS mape
FROM (SELECT f.model, a.v AS y, f.p, s.scale FROM forecasts f
      JOIN actual a ON a.item = f.item AND a.step = f.step JOIN scales s ON s.item = f.item
      WHERE a.v IS NOT NULL AND f.p IS NOT NULL)
GROUP BY 1""",
)
def auto(spark, sf_dir):
    """The statistical candidates, whose scores SQL can state."""
    cfg = AutoForecastConfig(cutoff="2000-12-31", global_model=False, states=False, autoregression=False, trend=False)
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    return rounded(run_auto_forecast(rows, cfg, "models/auto", CREATED).scores)


@query("job_auto_forecast_global")
def auto_global(spark, sf_dir):
    """The same with the fitted states of each item and the model over all items as further candidates."""
    cfg = AutoForecastConfig(cutoff="2000-12-31")
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    return rounded(run_auto_forecast(rows, cfg, "models/auto", CREATED).scores)


@query("job_auto_forecast_windows")
def auto_windows(spark, sf_dir):
    """All candidates over three windows, scores per window; fitted anew before each window's cut."""
    cfg = AutoForecastConfig(cutoff="2000-12-31", backtest_windows=3)
    rows = _retail(spark, sf_dir).select("item", "ts", "units")
    return rounded(run_auto_forecast(rows, cfg, "models/auto", CREATED).window_scores, "window")


@query(
    "target_dataset",
    _JOB_SQL
    + f"""
raw AS (
  SELECT g.item, g.d, g.d < {_CUTOFF} AS known, b.v, b.f FROM (
    SELECT item, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span
  ) g LEFT JOIN bins b ON g.item = b.item AND g.d = b.d
),
near AS (
  SELECT *,
    last_value(v IGNORE NULLS) OVER p AS pv,
    last_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER p AS pd,
    first_value(v IGNORE NULLS) OVER n AS nv,
    first_value(CASE WHEN v IS NOT NULL THEN d END IGNORE NULLS) OVER n AS nd
  FROM raw
  WINDOW p AS (PARTITION BY item, known ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY item, known ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)
SELECT strftime(d, '%Y-%m-%d') AS "timestamp", CAST(item AS VARCHAR) AS item_id, coalesce(CAST(f AS VARCHAR), 'False') AS has_cam,
       CAST(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
            ELSE (nv - pv) / (nd - pd) * (d - pd) + pv END AS FLOAT) AS target_value,
       CASE WHEN known THEN 'train' ELSE 'test' END AS split
FROM near""",
)
def dataset(spark, sf_dir):
    cfg = AutoForecastConfig(cutoff="2000-12-31", flag="has_campaign")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("item"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("units"),
        (F.col("l_returnflag") == "R").alias("has_campaign"),
    )
    return target_dataset(rows, cfg)
