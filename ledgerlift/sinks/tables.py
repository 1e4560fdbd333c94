"""Catalog tables: create-if-absent, guarded append, replace-load, counts, schema listing."""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.operators.merge import insert_if_absent

# DDL of the result tables (CSV-aligned column names).
TABLE_DDL = {
    "customer_transaction_stats": (
        "customer STRING, merchant STRING, transaction_count BIGINT, merchant_rank DOUBLE, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"),
    "customer_importance_scores": (
        "customer STRING, merchant STRING, avg_weight DOUBLE, weight_rank DOUBLE, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"),
    "eligible_merchants": (
        "merchant STRING, total_transactions BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP"),
    "customer_importance": (
        "Source STRING, Target STRING, Weight DOUBLE, typeTrans STRING, fraud INT, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"),
    "processing_log": (
        "query_id STRING, batch_id BIGINT, file_name STRING, processing_status STRING, "
        "detections_found BIGINT, error_message STRING, processed_at TIMESTAMP"),
    "pattern_detections": (
        "YStartTime STRING, detectionTime STRING, patternId STRING, ActionType STRING, "
        "customer STRING, merchant STRING, detection_timestamp TIMESTAMP"),
}
# pattern_detections with the batch as a partition, for streams (exactly-once append)
STREAM_DETECTIONS_DDL = TABLE_DDL["pattern_detections"] + ", batch_id BIGINT"


def _qualified(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def create_tables(spark: SparkSession, database: str | None = None, fmt: str = "parquet",
                  tables: Mapping[str, str] = TABLE_DDL) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for every result table; returns the names."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, cols in tables.items():
        full = _qualified(name, database)
        # with a batch id, a stream batch that runs twice replaces its own rows
        parts = " PARTITIONED BY (batch_id)" if "batch_id BIGINT" in cols else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING {fmt}{parts}")
        names.append(full)
    return names


def append_if_exists(df: DataFrame, table: str, stamp_col: str | None = "detection_timestamp") -> bool:
    """Append ``df`` (plus a load timestamp) when ``table`` exists; False otherwise.

    Columns are matched by name; a frame that does not fit the table's
    schema raises instead of being skipped.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return False
    out = df.withColumn(stamp_col, F.current_timestamp()) if stamp_col else df
    target_cols = spark.table(table).columns
    missing = [c for c in target_cols if c not in out.columns]
    extra = [c for c in out.columns if c not in target_cols]
    if missing or extra:
        raise ValueError(f"schema mismatch for {table}: missing {missing}, extra {extra}")
    out.select(*target_cols).write.mode("append").insertInto(table)
    return True


def table_location(spark: SparkSession, table: str) -> tuple[str, str]:
    """(location, format) of an unpartitioned file table."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is partitioned")
    return facts["Location"].rstrip("/"), facts["Provider"].lower()


def append_once(df: DataFrame, table: str, key: str) -> bool:
    """Appends rows to a plain file table exactly once per ``key``; False if that was done before.

    The table needs no column for the key.  The rows are written to a folder of their own in
    the table's ``_ledger`` (which readers skip) and moved into the table under names that
    carry the key; the ledger entry is closed last.  A try that was cut short leaves an open
    entry: the next one with the same key removes what it had moved and starts anew.  One writer
    per key at a time; rows that other writers append are not touched.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    missing, extra = set(columns) - set(df.columns), set(df.columns) - set(columns)
    if missing or extra:
        raise ValueError(f"schema mismatch for {table}: missing {sorted(missing)}, extra {sorted(extra)}")
    location, fmt = table_location(spark, table)
    name = re.sub(r"[^A-Za-z0-9]+", "-", key).strip("-") + "-" + hashlib.sha256(key.encode()).hexdigest()[:12]
    entry = f"{location}/_ledger/{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(location).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path(f"{entry}/_APPLIED")):
        return False
    schema = spark.table(table).schema
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields])
    rows.write.mode("overwrite").format(fmt).save(f"{entry}/rows")
    for status in fs.listStatus(path(location)):  # of an earlier try
        if status.getPath().getName().startswith(f"once-{name}-"):
            fs.delete(status.getPath(), False)
    parts = [s.getPath() for s in fs.listStatus(path(f"{entry}/rows")) if s.getPath().getName().startswith("part-")]
    for part in parts:
        if not fs.rename(part, path(f"{location}/once-{name}-{part.getName()}")):
            raise OSError(f"could not move {part.toString()} into {table}")
    fs.create(path(f"{entry}/_APPLIED")).close()
    spark.catalog.refreshTable(table)
    return True


def seed_table(spark: SparkSession, table: str, seed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An importance (or other keyed) table, filled with the seed's rows if it is empty, read again.

    The seed goes in through the ledger, one row per key, so a repeated or retried call adds
    nothing, and a table that has rows is left alone."""
    current = spark.table(table)
    if current.isEmpty():
        rows = insert_if_absent(current.select(*seed.columns), seed, keys)
        stamps = [c for c in ("created_at", "updated_at") if c in current.columns and c not in seed.columns]
        append_once(rows.withColumns({c: F.current_timestamp() for c in stamps}), table, "seed")
    return spark.table(table)


def replace_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Replace-load ``table`` with ``df`` (Spark refuses to overwrite a table it reads)."""
    df.write.mode("overwrite").format(fmt).saveAsTable(table)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each frame -- UNION ALL of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), F.col("row_count"))
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def column_listing(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(column_name, data_type, nullable) in ordinal order -- schema metadata only."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
