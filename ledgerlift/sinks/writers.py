"""Distributed writers: chunk files, detection batch files, table loads.

Nothing is collected to the driver: every writer is one Spark job whose
tasks write their own files.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators.chunking import assign_chunks


def write_chunked_csv(df: DataFrame, path: str, order_cols: Sequence[str], chunk_size: int,
                      chunk_col: str = "chunk_id", mode: str = "overwrite",
                      keep_cols: Sequence[str] | None = None, layout: str = "flat") -> None:
    """One CSV file (with header) per chunk of ``chunk_size`` consecutive rows.

    ``layout="flat"`` (default): all files in ``path``.  The rows are
    range-partitioned on the chunk id -- every task holds whole, contiguous
    chunks -- and sorted by position; ``maxRecordsPerFile = chunk_size`` then
    rolls a new file exactly at each chunk boundary.  File names sort in chunk
    order.  No directory per chunk, no dynamic-partition commit.

    ``layout="partitioned"``: ``path/<chunk_col>=<k>/`` with one file each
    (handy to read chunk ids back as a column; one folder per chunk).
    """
    chunked = assign_chunks(df, order_cols, chunk_size, chunk_col=chunk_col, pos_col="__ll_pos")
    cols = list(keep_cols) if keep_cols else [c for c in df.columns]
    if layout == "flat":
        (chunked.repartitionByRange(chunk_col)
         .sortWithinPartitions("__ll_pos")
         .select(*cols)
         .write.mode(mode).option("maxRecordsPerFile", chunk_size)
         .option("header", "true").csv(path))
    elif layout == "partitioned":
        (chunked.repartition(chunk_col)
         .sortWithinPartitions(chunk_col, "__ll_pos")
         .select(*cols, chunk_col)
         .write.mode(mode).partitionBy(chunk_col).option("header", "true").csv(path))
    else:
        raise ValueError(f"unknown layout {layout!r}")


def write_detection_batches(detections: DataFrame, path: str, batch_size: int = 50,
                            exact: bool = True, order_cols: Sequence[str] = ("merchant", "customer"),
                            mode: str = "append") -> None:
    """Detection CSV files of at most ``batch_size`` rows.

    ``exact=True``: consecutive batches in ``order_cols`` order, all full but
    the last one, flat in ``path`` (see :func:`write_chunked_csv`).  ``exact=False``: ``maxRecordsPerFile``,
    i.e. every task cuts its own rows into files of at most ``batch_size``
    rows -- no extra sort.  A failing task fails the job (no silently lost
    batch).
    """
    if exact:
        write_chunked_csv(detections, path, order_cols, batch_size, chunk_col="batch_id",
                          mode=mode)
    else:
        (detections.write.mode(mode).option("maxRecordsPerFile", batch_size)
         .option("header", "true").csv(path))


def detection_batches(detections: DataFrame, batch_size: int = 50,
                      order_cols: Sequence[str] = ("merchant", "customer")) -> DataFrame:
    """The batch assignment of :func:`write_detection_batches`, as a DataFrame."""
    return assign_chunks(detections, order_cols, batch_size, chunk_col="batch_id",
                         pos_col="batch_pos")


def write_partitioned_parquet(df: DataFrame, path: str, date_col: str,
                              mode: str = "overwrite") -> None:
    """Raw layout ``year=/month=/day=`` derived from ``date_col`` (partition pruning)."""
    (df.withColumn("year", F.year(date_col))
     .withColumn("month", F.month(date_col))
     .withColumn("day", F.dayofmonth(date_col))
     .repartition("year", "month", "day")
     .write.mode(mode).partitionBy("year", "month", "day").parquet(path))
