"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.compare_oracle import TABLES, frame_hash


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    # (those of the optional subpackage are tested in its own folder)
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_SQL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["YStartTime", "detectionTime", "patternId", "ActionType",
                          "customer", "merchant"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["customer_stats", "importance_scores", "detections",
                                  "detect_upgrades_per_chunk", "chunk_assignment",
                                  "detect_upgrades_hot_merchant"])
def test_results_do_not_depend_on_aqe_or_exchange_reuse(spark, duck, name):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.exchange.reuse")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "false")
        got = entry.queries()[name](spark, SF_SMALL).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert len(got) == len(want) and frame_hash(got) == frame_hash(want)
