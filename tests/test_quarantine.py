"""Bad files and lines: set aside with file, line and reason; everything else goes on."""

import os

import pytest

from ledgerlift import schemas
from ledgerlift.cli import main
from ledgerlift.plans import upgrade
from ledgerlift.plans.upgrade import detect_upgrades
from ledgerlift.sources.files import read_transactions_csv
from ledgerlift.sources.quarantine import read_checked_csv
from ledgerlift.streaming.files import IncrementalDetector, PerFileDetector, read_outputs, start_detection_stream
from tests.conftest import rows

HEADER = ",".join(schemas.TRANSACTIONS.fieldNames())


def _line(i, merchant="M1"):
    return f"{i},C{i % 7},'4',M,28007,{merchant},28007,es_food,{i}.5,0"


def _land(folder, name, lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join([header, *lines]) + "\n")


def _importance(spark):
    return spark.createDataFrame([(f"C{i}", "x", i / 10, "t", 0) for i in range(7)], schemas.IMPORTANCE)


def test_lines_and_headers(spark, tmp_dir):
    _land(tmp_dir, "a.csv", [_line(0), "1,C1,oops", "", _line(2).replace("2.5", "two"), _line(3), _line(4) + ",more"])
    _land(tmp_dir, "b.csv", [_line(5)], HEADER.replace("merchant", "shop"))
    _land(tmp_dir, "c.csv", [_line(6)], "﻿" + HEADER.upper().replace(",", ", "))
    _land(tmp_dir, "d.csv", [])
    open(os.path.join(tmp_dir, "e.csv"), "w").close()
    valid, rejects = read_checked_csv(spark, tmp_dir)
    assert [r[0] for r in rows(valid, "step")] == [0, 3, 6]
    assert valid.columns == [*schemas.TRANSACTIONS.fieldNames(), "source_file"]
    got = [(r.source_file[-5:], r.line_number, r.reject_reason, r.raw_line) for r in rejects.collect()]
    assert sorted(got) == [("a.csv", 3, "malformed", "1,C1,oops"), ("a.csv", 5, "malformed", _line(2).replace("2.5", "two")),
                           ("a.csv", 7, "malformed", _line(4) + ",more"), ("b.csv", 2, "header", _line(5))]


def test_good_files_read_as_before(spark, tmp_dir):
    for k in range(3):
        _land(tmp_dir, f"{k}.csv", [_line(i, f"M{i % 3}") for i in range(40 * k)])
    for strip in (False, True):
        valid, rejects = read_checked_csv(spark, tmp_dir, strip_quotes=strip)
        assert rejects.count() == 0
        assert rows(valid.drop("source_file")) == rows(read_transactions_csv(spark, tmp_dir, strip))


def test_line_numbers_across_splits(spark, tmp_dir):
    bad = {5, 700, 1999}
    _land(tmp_dir, "a.csv", ["x" if i in bad else _line(i) for i in range(2000)])
    keys = {"spark.sql.files.maxPartitionBytes": "9000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        valid, rejects = read_checked_csv(spark, tmp_dir)
        assert {r.line_number for r in rejects.collect()} == {i + 2 for i in bad} and valid.count() == 1997
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _five_files(folder):
    for k in range(5):
        lines = [_line(i, f"M{k % 2}") for i in range(60)]
        _land(folder, f"f{k}.csv", lines + (["broken"] if k == 1 else []), "no,such,header" if k == 3 else HEADER)


@pytest.mark.parametrize("files_per_batch", [1, 5])
def test_stream_goes_on_past_a_bad_file(spark, tmp_dir, files_per_batch):
    land, out, log, bad = (os.path.join(tmp_dir, n) for n in ("land", "out", "log", "bad"))
    _five_files(land)
    h = PerFileDetector(_importance, out, log, threshold=50, top_pct=0.5, low_pct=0.5, clock=lambda: "x", quarantine_path=bad)
    q = start_detection_stream(spark, land, h, max_files_per_trigger=files_per_batch)
    q.awaitTermination(300)
    assert q.exception() is None
    audit = {r.file_name[-6:]: r for r in read_outputs(spark, log).collect()}
    assert {f: r.processing_status for f, r in audit.items()} == {
        f"f{k}.csv": "QUARANTINED" if k == 3 else "SUCCESS" for k in range(5)}
    assert audit["f1.csv"].error_message == "1 lines rejected, the first at line 62" and audit["f0.csv"].error_message is None
    assert audit["f3.csv"].detections_found == 0 and audit["f0.csv"].detections_found > 0
    rejects = read_outputs(spark, bad).collect()
    assert sum(r.reject_reason == "header" for r in rejects) == 60
    assert [r.raw_line for r in rejects if r.reject_reason == "malformed"] == ["broken"]
    for k in (0, 1, 2, 4):
        one = spark.createDataFrame([(f"C{i % 7}", f"M{k % 2}") for i in range(60)], "customer string, merchant string")
        want = detect_upgrades(one, _importance(spark), 50, 0.5, 0.5, detected_at="x")
        got = read_outputs(spark, out).filter(f"source_file like '%f{k}.csv'")
        assert rows(got, "customer", "merchant") == rows(want, "customer", "merchant")


def test_incremental_stream_equals_batch(spark, tmp_dir):
    land, out, log, state, bad = (os.path.join(tmp_dir, n) for n in ("land", "out", "log", "state", "bad"))
    _five_files(land)
    options = dict(threshold=100, top_pct=0.5, low_pct=0.5)
    h = IncrementalDetector(_importance, out, log, clock=lambda: "2025-01-01 00:00:00", state_path=state, buckets=4,
                            quarantine_path=bad, keep_versions=3, **options)
    q = start_detection_stream(spark, land, h, max_files_per_trigger=2)
    q.awaitTermination(300)
    assert q.exception() is None
    everything, _ = read_checked_csv(spark, land)
    want = upgrade.detect_upgrades(everything, _importance(spark), detected_at="t", **options)
    assert rows(h.snapshot(spark, stamp="t")) == rows(want) and want.count() > 0
    # the records written batch by batch, less what was taken back, are the snapshot
    added = read_outputs(spark, out).select("batch_id", "customer", "merchant").collect()
    removed = read_outputs(spark, os.path.join(state, "removed")).collect()
    assert len(added) - len(removed) == want.count()


def test_detect_command_sets_bad_lines_aside(spark, tmp_dir):
    land, out, bad, imp = (os.path.join(tmp_dir, n) for n in ("land", "out", "bad", "imp.csv"))
    _five_files(land)
    _importance(spark).toPandas().to_csv(imp, index=False)
    main(["detect", "--transactions", land, "--importance", imp, "--out", out, "--quarantine", bad, "--per-file",
          "--threshold", "50", "--top-pct", "0.5", "--low-pct", "0.5"], spark)
    assert spark.read.parquet(bad).count() == 61
    assert spark.read.option("header", True).csv(out).count() > 0
    with pytest.raises(SystemExit):
        main(["detect", "--transactions", land, "--out", out], spark)
