"""Detection per chunk by windows."""

import random

import pytest

from ledgerlift.operators.chunking import assign_chunks
from ledgerlift.plans import upgrade
from tests.conftest import rows
from tests.test_plans import plan_text

IMP = "Source string, Target string, Weight double, typeTrans string, fraud int"


def _tx(n, seed):
    rng = random.Random(seed)
    return [(rng.choice([1, 1, 2, None]), rng.choice([f"C{i}" for i in range(25)] + [None]),
             rng.choice(["HOT", "HOT", "M1", "M2", None])) for _ in range(n)]


def _imp(spark):
    return spark.createDataFrame([(f"C{i}", None, w, "t", 0) for i in range(20) for w in ([0.5, None, 2.0][i % 3],)], IMP)


@pytest.mark.parametrize("scope", [(), ("part",)])
def test_windows_give_the_matches_of_the_cuts(spark, scope):
    tx, imp = spark.createDataFrame(_tx(600, 4), "part int, customer string, merchant string"), _imp(spark)
    cols = (*scope, "customer", "merchant", "transaction_count", "avg_weight")
    found = [rows(upgrade.pattern_matches(tx, imp, 40, 0.4, 0.5, scope, method=m), *cols) for m in ("auto", "window")]
    assert found[0] == found[1] and found[0]


@pytest.mark.parametrize("name", ["detect_upgrades_per_chunk", "detect_upgrades_per_source_chunk"])
def test_chunk_ranks_are_windows_over_one_shuffle(spark, name):
    text = plan_text(spark, name)
    assert "percent_rank" in text and "__ll_slice" not in text


def test_only_kept_columns_are_numbered(spark):
    df = spark.createDataFrame([(i * 7 % 50, i, "x") for i in range(50)], "k int, v int, wide string")
    out, whole = assign_chunks(df, ["k"], 8, keep=["v"]), assign_chunks(df, ["k"], 8)
    assert out.columns == ["v", "row_pos", "chunk_id"] and whole.columns == ["k", "v", "wide", "row_pos", "chunk_id"]
    assert rows(out) == rows(whole, *out.columns)
