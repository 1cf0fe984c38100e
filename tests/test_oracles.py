"""Every registered query agrees with its SQL on the same tables."""

import pytest

import __spark_entry__ as entry
from bindings.models import FEATURES
from check import SAME, difference, views

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return views(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(frame_of, con, name):
    frame = frame_of(name)
    want = con.sql(ORACLES[name])
    types = {f.name: SAME.get(f.dataType.simpleString()) for f in frame.schema}
    assert types == dict(zip(want.columns, map(str, want.types)))
    assert difference(frame.toPandas(), want.df()) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_returns_metrics_per_candidate(spark):
    rows = entry.entry(spark).collect()
    assert {r["model"] for r in rows} == {"seasonal_naive", "smoothing", "weighted_history"}
    assert all(r["wape"] > 0 for r in rows)


def test_models_read_whole_tables(spark, sf_dir):
    from bindings.models import lines

    rows = lines(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert set(FEATURES) <= set(rows.columns)
