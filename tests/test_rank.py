import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlift.operators.rank import percent_rank_within, rank_cut
from tests.conftest import rows


def brute_percent_rank(pdf, by, col, ascending):
    """(rank - 1) / (n - 1) with ties sharing the lowest rank; 0 for singletons."""
    out = []
    for _, g in pdf.groupby(by, dropna=False):
        vals = g[col].tolist()
        n = len(vals)
        for idx, v in zip(g.index, vals):
            less = sum(1 for w in vals if (w < v if ascending else w > v))
            out.append((idx, 0.0 if n == 1 else less / (n - 1)))
    return dict(out)


EXACT = [dict(method="sliced"), dict(method="histogram"),
         dict(method="auto"), dict(method="auto", slices=7)]


def _compare(spark, data, ascending):
    df = spark.createDataFrame(data, "id long, g string, v long")
    b = rows(percent_rank_within(df, "g", "v", ascending, "r", method="window"), "id", "r")
    for kw in EXACT:
        a = rows(percent_rank_within(df, "g", "v", ascending, "r", **kw), "id", "r")
        assert a == b, kw
    pdf = pd.DataFrame(data, columns=["id", "g", "v"]).set_index("id", drop=False)
    brute = brute_percent_rank(pdf, "g", "v", ascending)
    assert a == sorted(brute.items())


def test_ties_singletons_and_null_group(spark):
    data = [(1, "a", 5), (2, "a", 5), (3, "a", 3), (4, "a", 1), (5, "b", 7),
            (6, None, 2), (7, None, 2), (8, None, 9), (9, "c", 4), (10, "c", 4)]
    _compare(spark, data, ascending=True)
    _compare(spark, data, ascending=False)


def test_hot_group_spans_many_slices(spark):
    rnd = random.Random(7)
    # one group with a third of all rows and many distinct values, plus small groups
    data = [(i, "hot", rnd.randint(0, 400)) for i in range(3000)]
    data += [(3000 + i, f"g{i % 50}", rnd.randint(0, 20)) for i in range(6000)]
    df = spark.createDataFrame(data, "id long, g string, v long")
    b = rows(percent_rank_within(df, "g", "v", False, "r", method="window"), "id", "r")
    # neither the hot group nor its hot values are in one slice
    for kw in (dict(method="sliced"), dict(method="auto", slices=23)):
        assert rows(percent_rank_within(df, "g", "v", False, "r", **kw), "id", "r") == b


def test_null_values_rank_like_spark(spark):
    data = [(1, "a", None), (2, "a", 3), (3, "a", None), (4, "a", 8)]
    df = spark.createDataFrame(data, "id long, g string, v long")
    for asc in (True, False):
        b = rows(percent_rank_within(df, "g", "v", asc, "r", method="window"), "id", "r")
        for kw in EXACT:
            assert rows(percent_rank_within(df, "g", "v", asc, "r", **kw), "id", "r") == b


def test_rank_cut_equals_filtered_ranks(spark):
    rnd = random.Random(3)
    data = [(i, f"m{i % 7}", rnd.randint(1, 12)) for i in range(700)]
    df = spark.createDataFrame(data, "id long, g string, v long")
    for asc in (True, False):
        ranked = percent_rank_within(df, "g", "v", asc, "r", method="window")
        expect = rows(ranked.filter(F.col("r") <= 0.1), "id")
        for kw in EXACT:
            cut = rank_cut(df, "g", "v", asc, 0.1, "c", **kw)
            got = df.join(cut, "g").filter(F.col("v") <= F.col("c") if asc
                                           else F.col("v") >= F.col("c"))
            assert rows(got, "id") == expect, kw


def test_exact_boundary_one_tenth(spark):
    # 11 distinct counts: ranks 0.0, 0.1, 0.2, ... -> exactly two pass "<= 0.1"
    data = [(i, "m", 100 - i) for i in range(11)]
    df = spark.createDataFrame(data, "id long, g string, v long")
    cut = rank_cut(df, "g", "v", False, 0.1, "c").collect()
    assert cut[0]["c"] == 99


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(0, 6)),
                min_size=1, max_size=40))
def test_property_matches_window(spark, pairs):
    data = [(i, g, v) for i, (g, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "id long, g string, v long")
    b = rows(percent_rank_within(df, "g", "v", True, "r", method="window"), "id", "r")
    a = rows(percent_rank_within(df, "g", "v", True, "r", method="sliced"), "id", "r")
    assert a == b
