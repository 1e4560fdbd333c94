"""File stream: one file per batch, stream == batch, restart, replay, cumulative scope."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerlift import schemas
from ledgerlift.operators.chunking import assign_chunks
from ledgerlift.plans import upgrade
from ledgerlift.sinks.writers import write_chunked_csv
from ledgerlift.sources import tpch
from ledgerlift.sources.files import read_transactions_csv
from ledgerlift.streaming.files import (
    CumulativeDetector,
    PerFileDetector,
    compact_partials,
    throughput,
    read_outputs,
    start_detection_stream,
)
from tests.conftest import SF_SMALL, rows

CHUNK = 1200
PER_FILE_T = 110
FIXED = lambda: "2025-01-01 00:00:00"


def _string_tx(spark):
    """Landing-layout transactions plus the row key that fixes the chunk order."""
    tx = tpch.transactions(spark, SF_SMALL)
    extra = [c for c in tpch.ROW_KEY if c not in ("merchant", "amount")]
    return tpch.as_transaction_records(tx, keep=extra)


def _importance(spark):
    return tpch.customer_importance(spark, SF_SMALL).withColumn(
        "Source", F.col("Source").cast("string"))


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landing")
    flat = str(base / "flat")
    write_chunked_csv(_string_tx(spark), flat, tpch.ROW_KEY, CHUNK,
                      keep_cols=schemas.TRANSACTIONS.fieldNames())
    files = sorted(glob.glob(os.path.join(flat, "*.csv")))  # name order = chunk order
    assert len(files) == 5
    return base, flat, files


def _run(spark, handler, source, ckpt, files_per_batch=1):
    q = start_detection_stream(spark, source, handler, checkpoint_location=ckpt,
                               max_files_per_trigger=files_per_batch)
    q.awaitTermination(300)
    assert q.exception() is None
    return q


def test_one_file_per_batch_and_stream_equals_batch(spark, landing, tmp_dir):
    base, flat, files = landing
    out, log, ckpt = (os.path.join(tmp_dir, n) for n in ("out", "log", "ckpt"))
    h = PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED)
    _run(spark, h, flat, ckpt)

    audit = read_outputs(spark, log)
    assert audit.count() == len(files) == 5
    assert rows(audit, "batch_id") == [(i,) for i in range(5)]
    assert {r.processing_status for r in audit.collect()} == {"SUCCESS"}

    streamed = rows(read_outputs(spark, out), "customer", "merchant")
    chunked = assign_chunks(_string_tx(spark), tpch.ROW_KEY, CHUNK)
    batch = upgrade.detect_upgrades(chunked, _importance(spark), PER_FILE_T,
                                    detected_at=FIXED(), scope=["chunk_id"])
    assert streamed == rows(batch, "customer", "merchant")
    assert sum(r.detections_found for r in audit.collect()) == len(streamed)

    # restart on the same checkpoint: nothing new, nothing repeated
    _run(spark, PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED),
         flat, ckpt)
    assert read_outputs(spark, log).count() == 5

    # a new file arrives: exactly one more batch
    extra = os.path.join(flat, "zz_transactions_chunk_9999.csv")
    shutil.copy(files[0], extra)
    _run(spark, PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED),
         flat, ckpt)
    assert rows(read_outputs(spark, log), "batch_id") == [(i,) for i in range(6)]
    os.remove(extra)


def test_many_files_per_batch_keep_per_file_results(spark, landing, tmp_dir):
    _, flat, files = landing
    out, log, ckpt = (os.path.join(tmp_dir, n) for n in ("out", "log", "ckpt"))
    h = PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED)
    _run(spark, h, flat, ckpt, files_per_batch=3)
    assert rows(throughput(spark, log), "batch_id", "rows") == [(0, 3 * CHUNK), (1, 2 * CHUNK)]
    audit = read_outputs(spark, log)
    assert rows(audit, "batch_id") == [(0,), (0,), (0,), (1,), (1,)]
    det = read_outputs(spark, out)
    chunked = assign_chunks(_string_tx(spark), tpch.ROW_KEY, CHUNK)
    batch = upgrade.detect_upgrades(chunked, _importance(spark), PER_FILE_T,
                                    detected_at=FIXED(), scope=["chunk_id"])
    assert rows(det, "customer", "merchant") == rows(batch, "customer", "merchant")
    per_file = {r.file_name.rsplit("/", 1)[1]: r.detections_found for r in audit.collect()}
    by_file = {r.source_file.rsplit("/", 1)[1]: r["count"]
               for r in det.groupBy("source_file").count().collect()}
    assert per_file == {f: by_file.get(f, 0) for f in per_file}


def test_replayed_batch_overwrites(spark, landing, tmp_dir):
    _, flat, files = landing
    out, log = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "log")
    h = PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED,
                        scratch_root=os.path.join(tmp_dir, "scratch"))
    batch = read_transactions_csv(spark, files[1])
    h(batch, 7)
    first = rows(read_outputs(spark, out))
    h(batch, 7)  # at-least-once re-run of the same batch id
    assert rows(read_outputs(spark, out)) == first
    assert read_outputs(spark, log).count() == 1
    # intermediate tables are reused from batch to batch, not accumulated
    scratch = sorted(os.listdir(h.scratch_root))
    h(read_transactions_csv(spark, files[2]), 8)
    assert sorted(os.listdir(h.scratch_root)) == scratch


def test_cumulative_scope_equals_batch_on_all_rows(spark, landing, tmp_dir):
    _, flat, files = landing
    out, log, stats, ckpt = (os.path.join(tmp_dir, n) for n in ("out", "log", "stats", "ckpt"))
    h = CumulativeDetector(_importance, out, log, threshold=550, stats_path=stats, clock=FIXED)
    _run(spark, h, flat, ckpt)
    last = read_outputs(spark, out).filter(F.col("batch_id") == len(files) - 1)
    batch = upgrade.detect_upgrades(_string_tx(spark), _importance(spark), 550, detected_at=FIXED())
    assert rows(last, "customer", "merchant") == rows(batch, "customer", "merchant")


def test_compacted_partials_give_same_snapshot(spark, landing, tmp_dir):
    _, flat, files = landing
    out, log, stats, ckpt = (os.path.join(tmp_dir, n) for n in ("out", "log", "stats", "ckpt"))
    h = CumulativeDetector(_importance, out, log, threshold=550, stats_path=stats, clock=FIXED)
    _run(spark, h, flat, ckpt)
    base = compact_partials(spark, stats, 2, os.path.join(tmp_dir, "base"))
    h2 = CumulativeDetector(_importance, os.path.join(tmp_dir, "out2"), os.path.join(tmp_dir, "log2"),
                            threshold=550, stats_path=stats, compacted=(base, 2), clock=FIXED)
    last = read_transactions_csv(spark, files[-1])
    h2(last, len(files) - 1)
    again = read_outputs(spark, os.path.join(tmp_dir, "out2"))
    first = read_outputs(spark, out).filter(F.col("batch_id") == len(files) - 1)
    assert rows(again, "customer", "merchant") == rows(first, "customer", "merchant")


def test_cumulative_new_only_emits_each_pair_once(spark, landing, tmp_dir):
    _, flat, files = landing
    snap_out, new_out = os.path.join(tmp_dir, "snap"), os.path.join(tmp_dir, "new")
    stats1, stats2 = os.path.join(tmp_dir, "s1"), os.path.join(tmp_dir, "s2")
    _run(spark, CumulativeDetector(_importance, snap_out, os.path.join(tmp_dir, "l1"),
                                   threshold=300, stats_path=stats1, clock=FIXED),
         flat, os.path.join(tmp_dir, "c1"))
    _run(spark, CumulativeDetector(_importance, new_out, os.path.join(tmp_dir, "l2"),
                                   threshold=300, stats_path=stats2, new_only=True, clock=FIXED),
         flat, os.path.join(tmp_dir, "c2"))
    snaps = read_outputs(spark, snap_out)
    news = read_outputs(spark, new_out)
    pairs = rows(news, "customer", "merchant")
    assert len(pairs) == len(set(pairs))                       # never emitted twice
    assert set(pairs) == set(rows(snaps, "customer", "merchant"))  # everything ever seen
    for b in range(len(files)):
        seen_before = set(rows(snaps.filter(F.col("batch_id") < b), "customer", "merchant"))
        now = set(rows(snaps.filter(F.col("batch_id") == b), "customer", "merchant"))
        assert set(rows(news.filter(F.col("batch_id") == b), "customer", "merchant")) == \
            now - seen_before


def test_automatic_compaction_keeps_snapshots(spark, landing, tmp_dir):
    _, flat, files = landing
    plain_out, auto_out = os.path.join(tmp_dir, "plain"), os.path.join(tmp_dir, "auto")
    stats = os.path.join(tmp_dir, "stats")
    _run(spark, CumulativeDetector(_importance, plain_out, os.path.join(tmp_dir, "l1"),
                                   threshold=300, stats_path=os.path.join(tmp_dir, "s1"),
                                   clock=FIXED), flat, os.path.join(tmp_dir, "c1"))
    _run(spark, CumulativeDetector(_importance, auto_out, os.path.join(tmp_dir, "l2"),
                                   threshold=300, stats_path=stats, compact_every=2,
                                   clock=FIXED), flat, os.path.join(tmp_dir, "c2"))
    assert sorted(os.listdir(os.path.join(stats, "_compacted"))) == ["through=1", "through=3"]
    assert rows(read_outputs(spark, auto_out), "batch_id", "customer", "merchant") == \
        rows(read_outputs(spark, plain_out), "batch_id", "customer", "merchant")
    # partial folders read back without the compacted sums
    assert rows(read_outputs(spark, stats).select("batch_id").distinct()) == \
        [(i,) for i in range(len(files))]


def test_a_late_file_is_not_lost(spark, landing, tmp_dir):
    _, flat, files = landing
    here = os.path.join(tmp_dir, "landing")
    os.makedirs(here)
    shutil.copy(files[0], os.path.join(here, "a.csv"))
    out, log = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "log")

    def go():
        _run(spark, PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED), here, None)
    go()
    old = os.path.join(here, "b.csv")
    shutil.copy(files[1], old)
    os.utime(old, (1_000_000_000, 1_000_000_000))  # years before the newest seen file
    go()  # no checkpoint named: the one beside the outputs goes on
    assert rows(read_outputs(spark, log), "batch_id") == [(0,), (1,)]
    assert {r.file_name.rsplit("/", 1)[1] for r in read_outputs(spark, log).collect()} == {"a.csv", "b.csv"}


def test_outputs_without_their_checkpoint_are_not_overwritten(spark, landing, tmp_dir):
    _, flat, _ = landing
    out, log = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "log")
    _run(spark, PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED), flat,
         os.path.join(tmp_dir, "ckpt"))
    before = read_outputs(spark, log).count()
    with pytest.raises(ValueError, match="checkpoint"):
        _run(spark, PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED), flat, None)
    assert read_outputs(spark, log).count() == before


def test_half_written_base_loses_no_counts(spark, landing, tmp_dir):
    _, flat, files = landing
    stats = os.path.join(tmp_dir, "stats")

    def run_batches(name, *ids):
        h = CumulativeDetector(_importance, os.path.join(tmp_dir, name), os.path.join(tmp_dir, name + "-log"),
                               threshold=300, stats_path=stats, compact_every=2, clock=FIXED)
        for i in ids:
            h(read_transactions_csv(spark, files[i]), i)
        return h
    run_batches("a", 0, 1, 2)
    base = os.path.join(stats, "_compacted", "through=1")
    whole = rows(spark.read.parquet(base))
    first = rows(read_outputs(spark, os.path.join(tmp_dir, "a")), "batch_id", "customer", "merchant")
    os.remove(os.path.join(base, "_SUCCESS"))  # as if the write had been cut short
    part = sorted(f for f in os.listdir(base) if f.startswith("part-"))
    os.remove(os.path.join(base, part[0]))
    run_batches("b", 2)  # ignores the base
    run_batches("a", 1)  # writes it anew, whole
    assert rows(spark.read.parquet(base)) == whole
    assert rows(read_outputs(spark, os.path.join(tmp_dir, "b")), "batch_id", "customer", "merchant") == \
        [r for r in first if r[0] == 2]


def test_a_storage_error_is_not_an_empty_output(spark):
    from ledgerlift.streaming.files import path_exists
    assert not path_exists(spark, "/nowhere/at/all")
    with pytest.raises(Exception):
        path_exists(spark, "nosuchfs://bucket/x")


def test_an_unreadable_file_leaves_an_audit_row(spark, tmp_dir):
    here = os.path.join(tmp_dir, "landing")
    os.makedirs(here)
    with open(os.path.join(here, "bad.csv"), "w") as f:
        f.write("not,the,right,header\n1,2,3,4\n")
    log = os.path.join(tmp_dir, "log")
    h = PerFileDetector(_importance, os.path.join(tmp_dir, "out"), log, threshold=PER_FILE_T, clock=FIXED)
    with pytest.raises(Exception):
        _run(spark, h, here, None)
    row = read_outputs(spark, log).first()
    assert row.processing_status == "FAILED" and row.file_name.endswith("bad.csv") and row.error_message


def test_stream_writes_csv_files_and_tables_replay_safe(spark, landing, tmp_dir):
    from ledgerlift.sinks.tables import STREAM_DETECTIONS_DDL, TABLE_DDL, create_tables
    _, flat, files = landing
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_test")
    create_tables(spark, "stream_test", tables={"det": STREAM_DETECTIONS_DDL,
                                                "processing_log": TABLE_DDL["processing_log"]})
    out, log, small = (os.path.join(tmp_dir, n) for n in ("out", "log", "csv"))
    h = PerFileDetector(_importance, out, log, threshold=PER_FILE_T, clock=FIXED, csv_path=small, csv_rows=3,
                        table="stream_test.det", log_table="stream_test.processing_log")
    for _ in range(2):  # each batch twice
        for i in (0, 1):
            h(read_transactions_csv(spark, files[i]), i)
    want = rows(read_outputs(spark, out), "batch_id", "customer", "merchant")
    assert want and rows(spark.table("stream_test.det"), "batch_id", "customer", "merchant") == want
    assert rows(spark.read.option("header", True).csv(small), "customer", "merchant") == [r[1:] for r in sorted(
        want, key=lambda r: r[1:])]
    assert rows(spark.table("stream_test.processing_log"), "batch_id", "processing_status") == [
        (0, "SUCCESS"), (1, "SUCCESS")]
