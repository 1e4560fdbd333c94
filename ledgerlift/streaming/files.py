"""Checkpointed file stream of landing files -> detection per micro-batch.

``readStream`` CSV source (explicit schema, ``maxFilesPerTrigger`` files per
batch, 1 by default) -> ``foreachBatch`` handler -> outputs keyed by
``batch_id``.

* The stream checkpoint records which files were taken by which batch, so a
  restart neither skips nor repeats files.
* ``foreachBatch`` is at-least-once: a batch that failed (or whose commit was
  lost) runs again with the same ``batch_id`` and the same files.  Every
  output of a batch is written to ``.../batch_id=<n>`` with overwrite, so the
  re-run replaces, never duplicates.
* A failing batch fails the query (it is *not* marked done); after a restart
  it is retried from the checkpoint.
* ``percent_rank`` is not allowed on a streaming DataFrame, which is why the
  detection runs on the micro-batch DataFrame inside ``foreachBatch``.

Two scopes:

* :class:`PerFileDetector` -- detection on each file alone (scoped by source
  file, so one micro-batch may carry several files);
* :class:`CumulativeDetector` -- each batch stores its pair counts
  (``stats/batch_id=<n>``); detection runs on the sum over all stored batches,
  so the output of batch ``n`` is the snapshot over files ``0..n``.
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ledgerlift import schemas
from ledgerlift.functions.columns import detection_time_string
from ledgerlift.plans.incremental import MerchantState
from ledgerlift.plans.upgrade import (
    DEFAULT_LOW_PCT,
    DEFAULT_THRESHOLD,
    DEFAULT_TOP_PCT,
    customer_pairs,
    detect_upgrades,
    detection_records,
    matches_from_pairs,
)
from ledgerlift.operators.source_order import FILE, PLACE, SPLIT
from ledgerlift.session import reusable_scratch, scratch_path
from ledgerlift.sinks.tables import append_once
from ledgerlift.sinks.writers import write_detection_batches
from ledgerlift.sources.files import csv_options
from ledgerlift.sources.quarantine import BAD_HEADER, LINE, REASON, checked_lines, split_records

ImportanceLoader = Callable[[SparkSession], DataFrame]
SOURCE_FILE = "source_file"
STATUS, ERROR = "processing_status", "error_message"
FILE_ID = "__ll_file_id"
MAX_FILE_AGE = "36500d"


def discovery_options(max_files_per_trigger: int | None = 1, max_bytes_per_trigger: int | str | None = None,
                      nested: bool = False, archive_dir: str | None = None) -> dict:
    """Options of the file source: what a batch takes, where files lie, where finished ones go.

    A batch is bounded by files or, with ``max_bytes_per_trigger``, by bytes (at least one
    file).  ``nested`` looks into sub-folders, such as one per day.  With ``archive_dir`` the
    files of a batch are moved below it, under their own path, once the next batch has
    started, so the listing doesn't grow with the history."""
    # files count by name, not by age: one that lands late is still new
    options = {"maxFileAge": MAX_FILE_AGE}
    if max_bytes_per_trigger is not None:
        options["maxBytesPerTrigger"] = str(max_bytes_per_trigger)
    elif max_files_per_trigger is not None:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if nested:
        options["recursiveFileLookup"] = "true"
    if archive_dir:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    return options


def transaction_file_stream(spark: SparkSession, folder: str, strip_quotes: bool = False,
                            max_files_per_trigger: int | None = 1, schema=schemas.TRANSACTIONS,
                            **discovery) -> DataFrame:
    """Streaming DataFrame over the CSV files landing in ``folder``."""
    return (spark.readStream.schema(schema).options(**csv_options(strip_quotes))
            .options(**discovery_options(max_files_per_trigger, **discovery)).csv(folder))


def line_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = 1, **discovery) -> DataFrame:
    """The landing files as lines with their file and split, for handlers that check lines themselves."""
    return (spark.readStream.options(**discovery_options(max_files_per_trigger, **discovery)).text(folder)
            .select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT)))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any file system Spark knows; other errors are raised."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a table's write has been committed."""
    return path_exists(spark, f"{path}/_SUCCESS")


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame | None:
    """Names of a batch's input files, from the stream's own log (the files aren't read)."""
    for name in (str(batch_id), f"{batch_id}.compact"):
        log = f"{checkpoint.rstrip('/')}/sources/0/{name}"
        if path_exists(spark, log):
            entry = F.from_json("value", "path string, batchId long")
            return (spark.read.text(log).select(entry.alias("e"))
                    .filter(F.col("e.batchId") == batch_id).select(F.col("e.path").alias(SOURCE_FILE)))
    return None


def _batch_dir(root: str, batch_id: int) -> str:
    # ``batch_id`` comes back as a partition column when the root is read.
    return f"{root.rstrip('/')}/batch_id={batch_id}"


class _BatchHandler:
    """Shared parts: importance reload per batch, audit rows, idempotent paths."""

    def __init__(self, importance_loader: ImportanceLoader, output_path: str, log_path: str,
                 threshold: int = DEFAULT_THRESHOLD, top_pct: float = DEFAULT_TOP_PCT,
                 low_pct: float = DEFAULT_LOW_PCT, clock: Callable[[], str] = detection_time_string,
                 scratch_root: str | None = None, csv_path: str | None = None, csv_rows: int = 50,
                 table: str | None = None, log_table: str | None = None,
                 quarantine_path: str | None = None, strip_quotes: bool = False):
        self.importance_loader = importance_loader
        self.output_path = output_path
        self.log_path = log_path
        self.threshold = threshold
        self.top_pct = top_pct
        self.low_pct = low_pct
        self.clock = clock
        # intermediate tables of a batch; reused by the next batch (bounded space)
        self.scratch_root = scratch_root
        self.csv_path = csv_path        # detections also as CSV files of csv_rows rows
        self.csv_rows = csv_rows
        self.table = table              # ... and appended to this table, if it exists
        self.log_table = log_table      # audit rows also appended to this table, if it exists
        # bad files and lines go here, with file, line, reason and raw line, and stop nothing
        self.quarantine_path = quarantine_path
        self.strip_quotes = strip_quotes  # of lines that the handler parses itself
        self.checkpoint: str | None = None  # set when the stream starts
        self.query_id = ""

    def detections(self, batch: DataFrame, batch_id: int, stamp: str) -> DataFrame:
        raise NotImplementedError

    def _log(self, rows: DataFrame, batch_id: int, status: str, found: int | None,
             error: str | None, per_file: DataFrame | None = None, seconds: float | None = None) -> None:
        """One audit row per input file (``source_file, rows_read``) of the batch.

        ``rows`` may bring a file's own status and error; ``seconds`` is the batch's work so far."""
        if per_file is not None:
            rows = (rows.join(per_file, SOURCE_FILE, "left")
                    .withColumn("detections_found",
                                F.coalesce(F.col("detections_found"), F.lit(0)).cast("long")))
        else:
            rows = rows.withColumn("detections_found", F.lit(found).cast("long"))
        path = _batch_dir(self.log_path, batch_id)
        (rows.select(
            F.lit(self.query_id).alias("query_id"),
            F.col(SOURCE_FILE).alias("file_name"),
            F.col("rows_read").cast("long").alias("rows_read"),
            (F.col(STATUS) if STATUS in rows.columns else F.lit(status)).alias(STATUS),
            F.col("detections_found"),
            (F.col(ERROR) if ERROR in rows.columns else F.lit(error)).cast("string").alias(ERROR),
            F.current_timestamp().alias("processed_at"),
            F.lit(None if seconds is None else round(1000 * seconds)).cast("long").alias("duration_ms"))
         .write.mode("overwrite").parquet(path))
        if self.log_table and status == "SUCCESS":
            audit = rows.sparkSession.read.parquet(path).withColumn("batch_id", F.lit(batch_id).cast("long"))
            publish_batch(audit.drop("rows_read", "duration_ms"), self.log_table, batch_id, self.query_id)

    def _log_failure(self, spark: SparkSession, batch_id: int, error: str) -> None:
        """Audit rows of a failed batch, by file name only: what failed is not read again."""
        names = batch_files(spark, self.checkpoint, batch_id) if self.checkpoint else None
        if names is None:
            names = spark.createDataFrame([(None,)], f"{SOURCE_FILE} string")
        self._log(names.withColumn("rows_read", F.lit(None).cast("long")), batch_id, "FAILED", None, error)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stamp = self.clock()
        target = _batch_dir(self.output_path, batch_id)
        if self.scratch_root is None:
            self.scratch_root = scratch_path(batch.sparkSession, "stream-scratch")
        # A micro-batch is bounded by files or bytes and read by several
        # jobs (detection, audit): read the files once.  A lost block is
        # re-read from the same files.
        began = time.monotonic()
        if FILE in batch.columns:  # lines: places are taken before anything moves
            batch = batch.withColumn(PLACE, F.monotonically_increasing_id())
        else:  # the source file is taken before caching (input_file_name() is empty for cached rows)
            batch = batch.withColumn(SOURCE_FILE, F.input_file_name())
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._process(batch, batch_id, stamp, target, began)
        finally:
            batch.unpersist()

    @staticmethod
    def file_ids(batch: DataFrame) -> DataFrame:
        """Dense int id per input file of the batch (sorted names, so every
        evaluation gives the same ids).  At most maxFilesPerTrigger rows: the
        window over them and their broadcast are bounded."""
        names = batch.select(SOURCE_FILE).distinct()
        return F.broadcast(names.withColumn(
            FILE_ID, (F.row_number().over(Window.orderBy(SOURCE_FILE)) - 1).cast("int")))

    def _process(self, batch: DataFrame, batch_id: int, stamp: str, target: str, began: float) -> None:
        spark = batch.sparkSession
        try:
            with reusable_scratch(self.scratch_root):
                batch, counted = self._accepted(batch, batch_id)
                det = self.detections(batch, batch_id, stamp)
                # the count rides along with the write (no second action)
                seen = Observation(f"detections_{batch_id}")
                det.observe(seen, F.count(F.lit(1)).alias("n")) \
                   .write.mode("overwrite").parquet(target)
                found = seen.get.get("n", 0)
                self._publish(spark, batch_id, target)
                self._log(counted, batch_id, "SUCCESS", found, None, self.per_file_counts(spark, target),
                          time.monotonic() - began)
                self._after(spark)
        except Exception as exc:  # record, then let the query fail and retry
            self._log_failure(spark, batch_id, str(exc))
            raise

    def _accepted(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """The batch's valid rows, and one row per file for the audit.

        Lines are checked here: what is wrong goes to the quarantine, and a file with another
        header is audited as QUARANTINED; the other files of the batch go on."""
        if FILE not in batch.columns:
            return batch, batch.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows_read"))
        checked = checked_lines(batch, strip_quotes=self.strip_quotes)
        valid, rejects = split_records(checked)
        if self.quarantine_path:
            rejects.write.mode("overwrite").parquet(_batch_dir(self.quarantine_path, batch_id))
        files = batch.groupBy(F.col(FILE).alias(SOURCE_FILE)).agg(F.lit(0).alias("none")).drop("none")
        sums = checked.groupBy(SOURCE_FILE).agg(
            F.count(F.lit(1)).alias("n"), F.count(REASON).alias("bad"),
            F.max(F.col(REASON) == BAD_HEADER).alias("wrong"), F.min(F.when(F.col(REASON).isNotNull(), F.col(LINE))).alias("at"))
        wrong, bad = F.coalesce("wrong", F.lit(False)), F.coalesce("bad", F.lit(0))
        counted = files.join(sums, SOURCE_FILE, "left").select(
            SOURCE_FILE, F.coalesce("n", F.lit(0)).alias("rows_read"),
            F.when(wrong, "QUARANTINED").otherwise("SUCCESS").alias(STATUS),
            F.when(wrong, "the header is not the expected one")
            .when(bad > 0, F.format_string("%d lines rejected, the first at line %d", bad, F.col("at"))).alias(ERROR))
        return valid, counted

    def _after(self, spark: SparkSession) -> None:
        """Once a batch's outputs are written."""

    def _publish(self, spark: SparkSession, batch_id: int, target: str) -> None:
        """The batch's detections as small CSV files and as table rows (replacing an earlier try)."""
        if not (self.csv_path or self.table):
            return
        records = spark.read.parquet(target).select(*schemas.DETECTION_COLUMNS)
        if self.csv_path:
            write_detection_batches(records, _batch_dir(self.csv_path, batch_id), self.csv_rows, mode="overwrite")
        if self.table:
            publish_batch(records.withColumn("detection_timestamp", F.current_timestamp()), self.table, batch_id, self.query_id)

    def per_file_counts(self, spark: SparkSession, target: str) -> DataFrame | None:
        return None


class PerFileDetector(_BatchHandler):
    """PatId1 on every input file on its own.

    The detection is scoped by source file, so a micro-batch may carry many
    files (``max_files_per_trigger``) -- one distributed job for all of them --
    and still give exactly the per-file result.  Output rows carry the file.
    """

    def detections(self, batch, batch_id, stamp):
        imp = self.importance_loader(batch.sparkSession)  # reloaded for every batch
        # group by a small int per file, not by the path string
        ids = self.file_ids(batch)
        keyed = batch.join(ids, SOURCE_FILE).drop(SOURCE_FILE)
        det = detect_upgrades(keyed, imp, self.threshold, self.top_pct, self.low_pct,
                              detected_at=stamp, scope=[FILE_ID])
        return det.join(ids, FILE_ID).drop(FILE_ID)

    def per_file_counts(self, spark, target):
        out = spark.read.parquet(target)
        return out.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("detections_found"))


class CumulativeDetector(_BatchHandler):
    """PatId1 over all files seen so far (snapshot per batch).

    Every batch stores its pair counts under ``stats_path/batch_id=<n>``; the
    detection runs on their sum.  ``compact_every=K`` writes that sum every K
    batches to ``stats_path/_compacted/through=<n>`` (the folder Spark skips
    when reading ``stats_path``); later batches start from the newest such
    table found on storage, so the work per batch does not grow with the
    number of batches, also across restarts.  ``compacted=(path, through)``
    names a table made by :func:`compact_partials` by hand.  ``new_only=True``
    emits only (customer, merchant) pairs that no earlier batch emitted
    (anti-join with the earlier outputs) instead of the full snapshot.
    """

    def __init__(self, *args, stats_path: str, compacted: tuple[str, int] | None = None,
                 new_only: bool = False, compact_every: int | None = None, **kwargs):
        super().__init__(*args, **kwargs)
        self.stats_path = stats_path
        self.compacted = compacted
        self.new_only = new_only
        self.compact_every = compact_every

    def _compacted_root(self) -> str:
        return f"{self.stats_path.rstrip('/')}/_compacted"

    def _base(self, spark: SparkSession, batch_id: int) -> tuple[str, int] | None:
        """Newest complete compacted sum of batches before ``batch_id``.

        The sum that this batch itself writes, and one whose write was cut
        short, don't count."""
        found = self.compacted if self.compacted and self.compacted[1] < batch_id else None
        if self.compact_every:
            through = batch_id // self.compact_every * self.compact_every - 1
            while through >= 0 and (found is None or through > found[1]):
                path = f"{self._compacted_root()}/through={through}"
                if _complete(spark, path):
                    return path, through
                through -= self.compact_every
        return found

    def detections(self, batch, batch_id, stamp):
        spark = batch.sparkSession
        own = customer_pairs(batch)
        own.write.mode("overwrite").parquet(_batch_dir(self.stats_path, batch_id))
        base = self._base(spark, batch_id)
        # explicit paths: nothing is listed but what is read
        since = base[1] + 1 if base else 0
        paths = [_batch_dir(self.stats_path, b) for b in range(since, batch_id + 1)]
        partials = spark.read.schema(own.schema).parquet(*paths)
        if base:
            partials = partials.unionByName(spark.read.schema(own.schema).parquet(base[0]))
        pairs = (partials.groupBy("customer", "merchant")
                 .agg(F.sum("transaction_count").cast("long").alias("transaction_count")))
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            # the sum this batch needs anyway becomes the next base (idempotent on replay)
            target = f"{self._compacted_root()}/through={batch_id}"
            pairs.write.mode("overwrite").parquet(target)
            pairs = spark.read.schema(pairs.schema).parquet(target)
        imp = self.importance_loader(spark)
        matches = matches_from_pairs(pairs, imp, self.threshold, self.top_pct, self.low_pct)
        records = detection_records(matches, stamp)
        if self.new_only and batch_id > 0:
            paths = [_batch_dir(self.output_path, b) for b in range(batch_id)]
            earlier = spark.read.schema(schemas.DETECTIONS).parquet(*paths).select("customer", "merchant")
            records = records.join(earlier, ["customer", "merchant"], "left_anti")
        return records


class IncrementalDetector(_BatchHandler):
    """PatId1 over all files seen so far, at the cost of the merchants a batch touches.

    ``state_path`` holds the stored merchant tables (:class:`MerchantState`): statistics,
    scores, eligible merchants and detections as of each batch.  A batch ranks its own
    merchants again and leaves the rest in place.  Its output is what changed: new
    detections as records under ``output_path``, pairs that are no longer detected under
    ``<state_path>/removed/batch_id=<n>``; :meth:`snapshot` gives all detections as of a batch,
    equal to a batch detection over all files up to it.
    """

    def __init__(self, *args, state_path: str, buckets: int = 256, keep_versions: int | None = None, **kwargs):
        super().__init__(*args, **kwargs)
        self.state_path = state_path.rstrip("/")
        self.buckets = buckets
        self.keep_versions = keep_versions  # older versions' files are deleted (at least 2 for replays)

    def state(self, spark: SparkSession) -> MerchantState:
        return MerchantState(spark, f"{self.state_path}/tables", self.threshold, self.top_pct, self.low_pct, self.buckets)

    def detections(self, batch, batch_id, stamp):
        spark = batch.sparkSession
        state = self.state(spark)
        added, removed = state.apply(batch, self.importance_loader(spark), batch_id, stamp)
        removed.write.mode("overwrite").parquet(_batch_dir(f"{self.state_path}/removed", batch_id))
        return detection_records(added, stamp)

    def _after(self, spark: SparkSession) -> None:
        if self.keep_versions:
            self.state(spark).tables.vacuum(max(2, self.keep_versions))

    def snapshot(self, spark: SparkSession, batch_id: int | None = None, stamp: str | None = None) -> DataFrame:
        """Detection records over all files up to a batch (default: the last one)."""
        return detection_records(self.state(spark).detections(batch_id), stamp)


def compact_partials(spark: SparkSession, stats_path: str, through_batch_id: int,
                     target_path: str) -> str:
    """Sum the per-batch pair counts of batches ``<= through_batch_id`` into one
    table at ``target_path`` (a new location; the partials stay untouched)."""
    (spark.read.parquet(stats_path).filter(F.col("batch_id") <= through_batch_id)
     .groupBy("customer", "merchant")
     .agg(F.sum("transaction_count").cast("long").alias("transaction_count"))
     .write.parquet(target_path))
    return target_path


def start_detection_stream(spark: SparkSession, source_folder: str, handler: _BatchHandler,
                           checkpoint_location: str | None = None, available_now: bool = True,
                           processing_time: str = "2 seconds", strip_quotes: bool = False,
                           query_name: str | None = None, max_files_per_trigger: int | None = 1,
                           **discovery) -> StreamingQuery:
    """Start the file stream with ``handler`` as ``foreachBatch``.

    ``available_now=True`` drains the files present now and stops; otherwise
    it polls every ``processing_time``.  ``max_files_per_trigger`` files form
    one micro-batch (per-file results are unchanged for
    :class:`PerFileDetector`; :class:`CumulativeDetector` then emits one
    snapshot per batch instead of per file); ``max_bytes_per_trigger``, ``nested`` and
    ``archive_dir`` are those of :func:`discovery_options`.  A handler with a quarantine
    gets lines and checks them itself.
    """
    # one place per output folder, so a restart goes on where the last run ended
    checkpoint_location = checkpoint_location or f"{handler.output_path.rstrip('/')}/_checkpoint"
    if path_exists(spark, _batch_dir(handler.output_path, 0)) and not path_exists(spark, checkpoint_location):
        raise ValueError(f"{handler.output_path} holds outputs of a stream whose checkpoint is not at "
                         f"{checkpoint_location}: batches would be numbered anew and replace them")
    handler.checkpoint = checkpoint_location
    handler.query_id = query_name or handler.output_path
    if handler.quarantine_path:
        handler.strip_quotes = strip_quotes
        source = line_stream(spark, source_folder, max_files_per_trigger, **discovery)
    else:
        source = transaction_file_stream(spark, source_folder, strip_quotes, max_files_per_trigger, **discovery)
    writer = (source.writeStream.foreachBatch(handler)
              .option("checkpointLocation", checkpoint_location))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()


def throughput(spark: SparkSession, log_path: str) -> DataFrame:
    """Per batch, from the audit rows: input rows, seconds of work, rows per second of work.

    The time is the batch's own, as its handler measured it; waiting for files doesn't count."""
    per = (spark.read.parquet(log_path).filter("processing_status <> 'FAILED'").groupBy("batch_id")
           .agg(F.sum("rows_read").alias("rows"), (F.max("duration_ms") / 1000).alias("seconds")))
    return per.withColumn("rows_per_sec", F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")))


def publish_batch(df: DataFrame, table: str, batch_id: int, query_id: str = "") -> bool:
    """Append a batch's rows to a table, if it exists, exactly once.

    A table partitioned by ``batch_id`` has that partition replaced; any other table takes
    the rows through its ledger, under the query's and the batch's name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return False
    columns = spark.table(table).columns
    if not any(c.name == "batch_id" and c.isPartition for c in spark.catalog.listColumns(table)):
        if "batch_id" not in columns:
            df = df.drop("batch_id")
        return append_once(df, table, f"{query_id}/{batch_id}")
    rows = df.drop("batch_id")
    missing, extra = set(columns) - {"batch_id"} - set(rows.columns), set(rows.columns) - set(columns)
    if missing or extra:
        raise ValueError(f"schema mismatch for {table}: missing {sorted(missing)}, extra {sorted(extra)}")
    names = ", ".join(f"`{c}`" for c in columns if c != "batch_id")
    # a static partition: only this batch is replaced, whatever the session's overwrite mode
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) SELECT {names} FROM {{rows}}",
              rows=rows)
    return True


def read_outputs(spark: SparkSession, path: str) -> DataFrame:
    """All batch outputs (detections or audit rows) written so far."""
    return spark.read.parquet(path)
