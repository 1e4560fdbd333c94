"""Command line: the application around the library.

    python -m ledgerlift ingest --source DIR --landing DIR [--chunk-size 10000]
    python -m ledgerlift stream --landing DIR --importance PATH --out DIR --log DIR
                                [--threshold N] [--files-per-batch K] [--once]
    python -m ledgerlift detect --transactions PATH --importance PATH --out DIR
                                [--threshold N] [--per-file]

``ingest`` picks ``transactions.csv`` / ``CustomerImportance.csv`` in a
landing folder and cuts the transactions, in file order, into chunk files; ``stream`` runs
the checkpointed per-file (or ``--cumulative``) detection over a folder of
chunk files; ``detect`` is the same detection as one batch job.  The session
comes from ``SparkSession.builder`` (spark-submit / cluster settings apply).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerlift import schemas
from ledgerlift.operators.source_order import write_source_chunks
from ledgerlift.plans.upgrade import DEFAULT_THRESHOLD, detect_upgrades
from ledgerlift.session import DEFAULT_CONF, ensure_checkpoint_dir
from ledgerlift.sinks.writers import write_detection_batches
from ledgerlift.sources import files
from ledgerlift.sinks.tables import seed_table
from ledgerlift.sources.dimension import importance_chain
from ledgerlift.sources.quarantine import read_checked_csv
from ledgerlift.streaming.files import (
    CumulativeDetector,
    IncrementalDetector,
    PerFileDetector,
    SOURCE_FILE,
    start_detection_stream,
)


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("ledgerlift")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _importance_loader(a):
    """Read the table, seed it if empty, check its columns, fall back if told to."""
    def read(path):
        return lambda spark: files.read_importance_csv(spark, path, a.strip_quotes)

    def load(spark):
        if a.importance_table:  # a catalog table, seeded in place if it is empty
            if a.seed:
                seed_table(spark, a.importance_table, read(a.seed)(spark), schemas.IMPORTANCE_KEY)
            table = spark.table(a.importance_table)
            return importance_chain(spark, lambda _: table, fallback=read(a.fallback)(spark) if a.fallback else None)
        seed = read(a.seed)(spark) if a.seed else None
        fallback = read(a.fallback)(spark) if a.fallback else None
        return importance_chain(spark, read(a.importance), seed, fallback)
    return load


def cmd_ingest(spark: SparkSession, a) -> None:
    tx_path = files.pick_role_file(spark, a.source, "transactions.csv")
    files.pick_role_file(spark, a.source, "CustomerImportance.csv")  # both must be there
    tx = files.read_transactions_csv(spark, tx_path, a.strip_quotes)
    write_source_chunks(tx, a.landing, a.chunk_size)


def cmd_stream(spark: SparkSession, a) -> None:
    loader = _importance_loader(a)
    common = dict(threshold=a.threshold, top_pct=a.top_pct, low_pct=a.low_pct, csv_path=a.csv_out,
                  csv_rows=a.batch_size, table=a.table, log_table=a.log_table, quarantine_path=a.quarantine)
    if a.incremental:
        handler = IncrementalDetector(loader, a.out, a.log, state_path=a.stats, **common)
    elif a.cumulative:
        handler = CumulativeDetector(loader, a.out, a.log, stats_path=a.stats,
                                     compact_every=a.compact_every, **common)
    else:
        handler = PerFileDetector(loader, a.out, a.log, **common)
    q = start_detection_stream(spark, a.landing, handler, checkpoint_location=a.checkpoint,
                               available_now=a.once, strip_quotes=a.strip_quotes,
                               max_files_per_trigger=a.files_per_batch, max_bytes_per_trigger=a.bytes_per_batch,
                               nested=a.nested, archive_dir=a.archive)
    q.awaitTermination()


def cmd_detect(spark: SparkSession, a) -> None:
    if a.quarantine:  # bad files and lines are set aside instead of stopping the job
        tx, rejects = read_checked_csv(spark, a.transactions, strip_quotes=a.strip_quotes)
        rejects.write.mode("append").parquet(a.quarantine)
    else:
        tx = files.read_transactions_csv(spark, a.transactions, a.strip_quotes)
        if a.per_file:
            tx = tx.withColumn(SOURCE_FILE, F.input_file_name())
    imp = _importance_loader(a)(spark)
    scope = [SOURCE_FILE] if a.per_file else []
    det = detect_upgrades(tx, imp, a.threshold, a.top_pct, a.low_pct, scope=scope)
    write_detection_batches(det.select(*schemas.DETECTION_COLUMNS), a.out, a.batch_size,
                            mode="append")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlift")
    sub = p.add_subparsers(dest="cmd", required=True)

    def detection_args(sp):
        sp.add_argument("--threshold", type=int, default=DEFAULT_THRESHOLD)
        sp.add_argument("--top-pct", type=float, default=0.1)
        sp.add_argument("--low-pct", type=float, default=0.1)
        sp.add_argument("--strip-quotes", action="store_true")
        sp.add_argument("--quarantine", default=None, help="folder for bad files' and bad lines' records")
        sp.add_argument("--importance", default=None, help="importance CSV")
        sp.add_argument("--importance-table", default=None, help="importance catalog table; --seed fills it if empty")
        sp.add_argument("--seed", default=None, help="importance CSV that stands in for an empty one")
        sp.add_argument("--fallback", default=None, help="importance CSV used if the other lacks a column")

    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True)
    i.add_argument("--landing", required=True)
    i.add_argument("--chunk-size", type=int, default=10_000)
    i.add_argument("--strip-quotes", action="store_true")

    s = sub.add_parser("stream")
    s.add_argument("--landing", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--log", required=True)
    s.add_argument("--checkpoint", default=None, help="default: _checkpoint in the output folder")
    s.add_argument("--csv-out", default=None, help="detections also as CSV files of --batch-size rows")
    s.add_argument("--batch-size", type=int, default=50)
    s.add_argument("--table", default=None, help="detections also appended to this table, if it exists")
    s.add_argument("--log-table", default=None, help="audit rows also appended to this table, if it exists")
    s.add_argument("--files-per-batch", type=int, default=1)
    s.add_argument("--once", action="store_true", help="process the files present, then stop")
    s.add_argument("--cumulative", action="store_true")
    s.add_argument("--incremental", action="store_true",
                   help="cumulative scope by stored merchant tables: only touched merchants are ranked again")
    s.add_argument("--stats", default=None, help="folder of pair counts (cumulative) or tables (incremental)")
    s.add_argument("--bytes-per-batch", default=None, help="bound a batch by bytes instead of files")
    s.add_argument("--nested", action="store_true", help="look into sub-folders of the landing folder")
    s.add_argument("--archive", default=None, help="move finished files below this folder")
    s.add_argument("--compact-every", type=int, default=100,
                   help="cumulative scope: fold pair counts into one table every K batches")
    detection_args(s)

    d = sub.add_parser("detect")
    d.add_argument("--transactions", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--per-file", action="store_true")
    d.add_argument("--batch-size", type=int, default=50)
    detection_args(d)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if a.cmd == "stream" and (a.cumulative or a.incremental) and not a.stats:
        raise SystemExit("--cumulative and --incremental need --stats")
    if a.cmd in ("stream", "detect") and not (a.importance or a.importance_table):
        raise SystemExit("name --importance or --importance-table")
    spark = spark or _session()
    {"ingest": cmd_ingest, "stream": cmd_stream, "detect": cmd_detect}[a.cmd](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
