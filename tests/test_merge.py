import datetime as dt

from ledgerlift.operators.merge import insert_if_absent, unprocessed, upsert
from tests.conftest import rows

SCHEMA = "Source string, typeTrans string, Weight double"


def test_upsert_replaces_inserts_and_keeps(spark):
    target = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0)], SCHEMA)
    updates = spark.createDataFrame([("b", "x", 5.0), ("c", "y", 3.0)], SCHEMA)
    out = upsert(target, updates, ["Source", "typeTrans"], created_col=None, updated_col=None,
                 state_col="state")
    assert rows(out) == [("a", "x", 1.0, "kept"), ("b", "x", 5.0, "updated"),
                         ("c", "y", 3.0, "inserted")]


def test_upsert_timestamps(spark):
    t0 = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([("a", "x", 1.0, t0, t0), ("b", "x", 2.0, t0, t0)],
                                   SCHEMA + ", created_at timestamp, updated_at timestamp")
    updates = spark.createDataFrame([("b", "x", 5.0), ("c", "y", 3.0)], SCHEMA)
    now = "2025-02-02 00:00:00"
    got = {r.Source: r for r in upsert(target, updates, ["Source", "typeTrans"], as_of=now).collect()}
    assert got["a"].updated_at == t0 and got["a"].created_at == t0
    assert got["b"].created_at == t0 and got["b"].updated_at == dt.datetime(2025, 2, 2)
    assert got["c"].created_at == dt.datetime(2025, 2, 2)


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("a", "x", 1.0)], SCHEMA)
    new = spark.createDataFrame([("a", "x", 9.0), ("d", "x", 4.0), ("d", "x", 4.0)], SCHEMA)
    assert rows(insert_if_absent(target, new, ["Source", "typeTrans"])) == \
        [("a", "x", 1.0), ("d", "x", 4.0)]


def test_unprocessed_anti_join(spark):
    listed = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "name string")
    done = spark.createDataFrame([("f2",)], "name string")
    assert rows(unprocessed(listed, done, ["name"])) == [("f1",), ("f3",)]


def test_two_updates_of_one_key_are_an_error(spark):
    import pytest
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    updates = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="several updates of k=a"):
        upsert(target, updates, ["k"], created_col=None, updated_col=None).collect()


def test_insert_if_absent_takes_the_first_in_order(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 5), ("b", 4), ("b", None), ("c", 7)], "k string, v int")
    assert rows(insert_if_absent(target, new.filter("v is not null"), ["k"])) == [("a", 1), ("b", 4), ("c", 7)]
