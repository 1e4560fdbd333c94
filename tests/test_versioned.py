"""Versioned tables: copy-on-write of touched buckets, one switch, replays; merchant state."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators.merge import upsert
from ledgerlift.plans import upgrade
from ledgerlift.plans.incremental import DETECTED, ELIGIBLE, SCORES, STATS, MerchantState
from ledgerlift.sinks.versioned import VersionedTables
from tests.conftest import rows

DDL = "Source STRING, typeTrans STRING, Weight DOUBLE, created_at TIMESTAMP, updated_at TIMESTAMP"
KEYS = ["Source", "typeTrans"]


def _updates(spark, items):
    return spark.createDataFrame(items, "Source string, typeTrans string, Weight double")


def _table(spark, root):
    return VersionedTables(spark, root, {"imp": (DDL, ["Source"])}, buckets=8)


def _content(df):
    return sorted((r.Source, r.typeTrans, r.Weight, str(r.created_at), str(r.updated_at)) for r in df.collect())


def test_upsert_touches_its_buckets_only(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    first = [(f"C{i}", "a", float(i)) for i in range(60)]
    assert t.upsert("imp", _updates(spark, first), KEYS, as_of="2025-01-01 00:00:00") == 0
    before = t.read("imp", 0)
    files = set(before.inputFiles())
    change = _updates(spark, [("C7", "a", 70.0), ("C7", "b", 71.0)])
    assert t.upsert("imp", change, KEYS, as_of="2025-01-02 00:00:00") == 1
    touched = t.touched("imp", change)
    assert len(touched) == 1
    after = set(t.read("imp").inputFiles())
    # untouched buckets keep their very files; the touched one has only new ones
    assert {f for f in files if f"bucket={touched[0]}/" not in f} == {f for f in after if "version=0" in f}
    assert all(f"bucket={touched[0]}/" in f for f in after - files)
    assert os.listdir(os.path.join(tmp_dir, "data", "imp", "version=1")).count(f"bucket={touched[0]}") == 1
    old = _updates(spark, first).withColumns({c: F.lit("2025-01-01 00:00:00").cast("timestamp")
                                              for c in ("created_at", "updated_at")})
    assert _content(t.read("imp")) == _content(upsert(old, change, KEYS, as_of="2025-01-02 00:00:00"))
    # the old version is still whole
    assert _content(t.read("imp", 0)) == _content(old)


def test_readers_see_one_version(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.upsert("imp", _updates(spark, [(f"C{i}", "a", 1.0) for i in range(40)]), KEYS)
    t.publish("imp", "versioned_imp")
    reader = spark.table("versioned_imp")             # resolved before the upsert
    t.upsert("imp", _updates(spark, [(f"C{i}", "a", 2.0) for i in range(0, 40, 9)]), KEYS)
    assert {r.Weight for r in spark.table("versioned_imp").collect()} == {1.0}  # committed, not yet switched
    t.publish("imp", "versioned_imp")
    assert {r.Weight for r in reader.collect()} == {1.0} and reader.count() == 40
    now = spark.table("versioned_imp")
    assert now.count() == 40 and now.filter("Weight = 2").count() == 5
    spark.sql("DROP VIEW versioned_imp")


def test_uncommitted_and_repeated_versions(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.upsert("imp", _updates(spark, [("A", "x", 1.0), ("B", "x", 1.0)]), KEYS, version=0)
    broken = _updates(spark, [("A", "x", 5.0), ("A", "x", 6.0)])
    with pytest.raises(Exception, match="several updates"):
        t.upsert("imp", broken, KEYS, version=1)
    assert t.versions() == [0] and t.read("imp").count() == 2
    for _ in range(2):  # the same version twice: same base, same result
        t.upsert("imp", _updates(spark, [("A", "x", 7.0), ("C", "x", 1.0)]), KEYS, version=1)
        assert sorted((r.Source, r.Weight) for r in t.read("imp").collect()) == [("A", 7.0), ("B", 1.0), ("C", 1.0)]
    with pytest.raises(Exception, match="outside the touched buckets"):
        t.commit({"imp": (t.read("imp"), t.touched("imp", _updates(spark, [("A", "x", 1.0)])))}, 2)
    with pytest.raises(ValueError, match="must be keys"):
        t.upsert("imp", broken, ["typeTrans"])


def test_vacuum_keeps_live_files(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    for v in range(4):
        t.upsert("imp", _updates(spark, [("A", "x", float(v)), *([(f"C{i}", "x", 0.0) for i in range(30)] if not v else [])]), KEYS)
    want = _content(t.read("imp"))
    assert t.vacuum(keep=2) and t.versions() == [2, 3]
    assert _content(t.read("imp")) == want and t.read("imp", 2).count() == 31
    assert not t.vacuum(keep=2)


def test_empty_table_and_view(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    assert t.read("imp").count() == 0 and t.latest() == -1
    t.publish("imp", "versioned_none")
    assert spark.table("versioned_none").count() == 0
    spark.sql("DROP VIEW versioned_none")


# -- merchant state --------------------------------------------------------

TX = "customer string, merchant string"
IMP = "Source string, Target string, Weight double, typeTrans string, fraud int"


def _batches(seed=3, n=5):
    rng = random.Random(seed)
    customers = [f"C{i}" for i in range(60)] + [None]
    out = []
    for b in range(n):
        merchants = ["HOT"] * 6 + rng.sample([f"M{i}" for i in range(30)], 4) + [None]
        out.append([(rng.choice(customers), rng.choice(merchants)) for _ in range(400)])
    return [*out[:2], [], *out[2:]]


def _importance(spark, seed=1):
    rng = random.Random(seed)
    data = [(f"C{i}", "t", rng.choice([0.1, 0.5, 0.5, None, 2.0]), k, 0) for i in range(50) for k in "ab"[:rng.randrange(1, 3)]]
    return spark.createDataFrame(data, IMP)


def _rounded(df, *cols):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=str)


def test_state_equals_the_batch_result_after_each_batch(spark, tmp_dir):
    options = dict(threshold=60, top_pct=0.3, low_pct=0.4)
    state = MerchantState(spark, tmp_dir, buckets=16, **options)
    seen, current = [], set()
    for version, data in enumerate(_batches()):
        imp = _importance(spark, 1 if version < 4 else 2)  # the importance table changes once
        seen += data
        stamp = f"2025-01-0{version + 1} 00:00:00"
        batch, everything = spark.createDataFrame(data, TX), spark.createDataFrame(seen, TX)
        for _ in range(2 if version == 3 else 1):  # one batch runs twice
            added, removed = state.apply(batch, imp, version, stamp)
        current = (current | set(map(tuple, added.collect()))) - set(map(tuple, removed.collect()))
        t = state.tables
        want = upgrade.detect_upgrades(everything, imp, detected_at="x", **options)
        assert rows(state.detections(), "customer", "merchant") == rows(want, "customer", "merchant")
        assert sorted(current) == rows(want, "customer", "merchant")
        cols = ("customer", "merchant", "transaction_count", "merchant_rank")
        assert _rounded(t.read(STATS), *cols) == _rounded(upgrade.customer_stats(everything), *cols)
        cols = ("customer", "merchant", "avg_weight", "weight_rank")
        assert _rounded(t.read(SCORES), *cols) == _rounded(upgrade.importance_scores(everything, imp), *cols)
        cols = ("merchant", "total_transactions")
        assert _rounded(t.read(ELIGIBLE), *cols) == _rounded(
            upgrade.eligible_merchants(everything, 60).filter("merchant is not null"), *cols)
        # only buckets of the batch's merchants were written
        touched = set(t.touched(STATS, batch)) if version != 4 else set(range(16))
        for table in (STATS, SCORES, ELIGIBLE, DETECTED):
            assert {b for (name, b), at in t.manifest(version).items() if name == table and at == version} <= touched
    assert len(rows(want, "customer", "merchant")) > 3
    stamps = t.read(STATS).groupBy("merchant").agg(F.max("updated_at").cast("string").alias("u"),
                                                   F.min("created_at").cast("string").alias("c")).collect()
    assert {r.c[:10] for r in stamps if r.merchant == "HOT"} == {"2025-01-01"}


def test_untouched_merchants_are_not_read(spark, tmp_dir, monkeypatch):
    state = MerchantState(spark, tmp_dir, threshold=1, buckets=64)
    imp = _importance(spark)
    state.apply(spark.createDataFrame([(f"C{i % 9}", f"M{i % 40}") for i in range(400)], TX), imp, 0, "2025-01-01 00:00:00")
    read, taken = state.tables.read, []
    monkeypatch.setattr(state.tables, "read", lambda *a: taken.append(read(*a)) or taken[-1])
    batch = spark.createDataFrame([("C1", "M5"), ("C2", "M5")], TX)
    state.apply(batch, imp, 1, "2025-01-02 00:00:00")
    bucket = state.tables.touched(STATS, batch)
    files = [f for df in taken for f in df.inputFiles()]
    assert len(bucket) == 1 and files and all(f"bucket={bucket[0]}/" in f for f in files)
