"""Appends that happen once per key, seeds that stay, landing folders that are cleared."""

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from ledgerlift import schemas
from ledgerlift.sinks import tables
from ledgerlift.streaming import files as streaming
from ledgerlift.streaming.files import PerFileDetector, read_outputs, start_detection_stream, throughput
from tests.conftest import rows
from tests.test_quarantine import _importance, _land, _line


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS once_test")
    yield "once_test"
    spark.sql("DROP DATABASE once_test CASCADE")


def _handler(tmp_dir, **options):
    out, log = (os.path.join(tmp_dir, n) for n in ("out", "log"))
    return PerFileDetector(_importance, out, log, threshold=5, top_pct=0.5, low_pct=0.5, clock=lambda: "x", **options)


def _batch(spark, n=30):
    return spark.createDataFrame([(f"C{i % 7}", "M1") for i in range(n)], "customer string, merchant string")


def test_replay_into_plain_tables_adds_no_row(spark, tmp_dir, database):
    tables.create_tables(spark, database)
    assert "batch_id" not in spark.table(f"{database}.pattern_detections").columns
    h = _handler(tmp_dir, table=f"{database}.pattern_detections", log_table=f"{database}.processing_log")
    for batch in (0, 0, 1, 0, 1):
        h(_batch(spark), batch)
    found = read_outputs(spark, h.output_path).count()
    assert found > 2 and spark.table(f"{database}.pattern_detections").count() == found
    assert rows(spark.table(f"{database}.processing_log"), "batch_id") == [(0,), (1,)]
    # other appends stay, whatever the stream does
    extra = spark.table(f"{database}.pattern_detections").limit(1)
    assert tables.append_if_exists(extra.drop("detection_timestamp"), f"{database}.pattern_detections")
    h(_batch(spark), 1)
    assert spark.table(f"{database}.pattern_detections").count() == found + 1


def test_a_try_that_was_cut_short_is_undone(spark, tmp_dir, database):
    spark.sql(f"CREATE TABLE {database}.t (a BIGINT) USING parquet")
    df = spark.range(100).select(F.col("id").alias("a")).repartition(4)
    assert tables.append_once(df, f"{database}.t", "q/1")
    location, _ = tables.table_location(spark, f"{database}.t")
    folder = location.removeprefix("file:")
    entry, = os.listdir(os.path.join(folder, "_ledger"))
    os.remove(os.path.join(folder, "_ledger", entry, "_APPLIED"))  # as if it had stopped while moving
    moved = sorted(f for f in os.listdir(folder) if f.startswith("once-"))
    os.remove(os.path.join(folder, moved[0]))
    spark.catalog.refreshTable(f"{database}.t")
    assert spark.table(f"{database}.t").count() < 100
    assert tables.append_once(df, f"{database}.t", "q/1")
    assert rows(spark.table(f"{database}.t")) == [(i,) for i in range(100)]
    assert not tables.append_once(df, f"{database}.t", "q/1") and tables.append_once(df, f"{database}.t", "q-1")
    assert spark.table(f"{database}.t").count() == 200
    with pytest.raises(ValueError, match="schema mismatch"):
        tables.append_once(df.withColumn("b", F.lit(1)), f"{database}.t", "q/2")


def test_seed_is_written_back_once(spark, tmp_dir, database):
    tables.create_tables(spark, database)
    name = f"{database}.customer_importance"
    seed = spark.createDataFrame([("C1", "M", 0.5, "a", 0), ("C1", "M", 0.7, "a", 0), ("C2", "M", 0.1, "a", 0)], schemas.IMPORTANCE)
    for _ in range(2):
        got = tables.seed_table(spark, name, seed, schemas.IMPORTANCE_KEY)
        assert [r[:2] for r in rows(got, "Source", "Weight")] == [("C1", 0.5), ("C2", 0.1)]
        assert got.filter("created_at is null").count() == 0
    spark.sql(f"TRUNCATE TABLE {name}")
    spark.createDataFrame([("C9", "M", 1.0, "a", 0)], schemas.IMPORTANCE).withColumns(
        {c: F.current_timestamp() for c in ("created_at", "updated_at")}).write.insertInto(name)
    assert rows(tables.seed_table(spark, name, seed, schemas.IMPORTANCE_KEY), "Source") == [("C9",)]


def _run(spark, handler, source, ckpt, **options):
    q = start_detection_stream(spark, source, handler, checkpoint_location=ckpt, **options)
    q.awaitTermination(300)
    assert q.exception() is None


def test_nested_folders_and_byte_bound(spark, tmp_dir):
    land, ckpt = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "ckpt")
    for k in range(6):
        _land(os.path.join(land, f"2025/01/0{k // 2 + 1}"), f"f{k}.csv", [_line(i) for i in range(50)])
        time.sleep(0.01)
    size = os.path.getsize(os.path.join(land, "2025/01/01/f0.csv"))
    h = _handler(tmp_dir)
    _run(spark, h, land, ckpt, max_bytes_per_trigger=2 * size, nested=True)
    audit = read_outputs(spark, h.log_path)
    assert audit.count() == 6 and [r["count"] for r in audit.groupBy("batch_id").count().orderBy("batch_id").collect()] == [2, 2, 2]


def test_finished_files_are_archived(spark, tmp_dir):
    land, ckpt, done = (os.path.join(tmp_dir, n) for n in ("in/land", "ckpt", "done"))
    for k in range(3):
        _land(os.path.join(land, "day1"), f"f{k}.csv", [_line(i) for i in range(50)])
    h = _handler(tmp_dir)
    options = dict(nested=True, archive_dir=done, max_files_per_trigger=1)
    _run(spark, h, land, ckpt, **options)
    _land(os.path.join(land, "day2"), "g.csv", [_line(i) for i in range(50)])
    _run(spark, h, land, ckpt, **options)
    left = [f for _, _, names in os.walk(land) for f in names if f.endswith(".csv")]
    archived = sorted(f for _, _, names in os.walk(done) for f in names if f.endswith(".csv"))
    assert len(left) <= 1 and archived[:3] == ["f0.csv", "f1.csv", "f2.csv"]
    audit = read_outputs(spark, h.log_path)
    assert sorted(r.file_name[-5:] for r in audit.collect()) == ["f0.csv"[-5:], "f1.csv"[-5:], "f2.csv"[-5:], "g.csv"]


def test_waiting_does_not_lower_the_rate(spark, tmp_dir, monkeypatch):
    h = _handler(tmp_dir)
    h(_batch(spark), 0)
    clock = time.monotonic
    monkeypatch.setattr(streaming.time, "monotonic", lambda: clock() + 10_000)  # a pause between batches
    h(_batch(spark), 1)
    got = {r.batch_id: r for r in throughput(spark, h.log_path).collect()}
    assert all(0 < r.seconds < 300 and r.rows_per_sec == r.rows / r.seconds for r in got.values()) and set(got) == {0, 1}


def test_csv_output_leaves_no_scratch_behind(spark, tmp_dir):
    h = _handler(tmp_dir, csv_path=os.path.join(tmp_dir, "csv"), csv_rows=2, scratch_root=os.path.join(tmp_dir, "scratch"))
    h(_batch(spark), 0)
    first, root = sorted(os.listdir(h.scratch_root)), os.path.join(spark.conf.get("spark.checkpoint.dir"), "ledgerlift")
    before = len(os.listdir(root)) if os.path.isdir(root) else 0
    for batch in (1, 2):
        h(_batch(spark), batch)
    assert sorted(os.listdir(h.scratch_root)) == first
    assert (len(os.listdir(root)) if os.path.isdir(root) else 0) == before
    shutil.rmtree(h.scratch_root)
