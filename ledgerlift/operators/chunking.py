"""Cut a table into consecutive fixed-size row chunks, exactly, in parallel.

The position of a row in a global order is computed the way ``zipWithIndex``
does it, but with DataFrame operators:

1. range-partition on the (unique) order key and sort inside each partition --
   balanced partitions, no single-partition sort;
2. ``monotonically_increasing_id`` encodes (partition index, index inside the
   partition);
3. per-partition row counts -> exclusive prefix sum.  That table has exactly
   one row per partition, so broadcasting it is bounded by the partition
   count, never by the data.

The sorted, id-tagged rows are materialized once (Parquet in the shared
checkpoint folder): both readers (counts and numbering) must see the same
sampled range bounds, and a retried task must not re-sample them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.functions.columns import ceil_div, percent_of
from ledgerlift.session import freeze

_MID = "__ll_mid"
_PART = "__ll_part"
_LOCAL = "__ll_local"
_CNT = "__ll_cnt"
_OFF = "__ll_off"
_LOCAL_BITS = 33


def with_row_position(df: DataFrame, order_cols: Sequence[str], pos_col: str = "row_pos",
                      num_partitions: int | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` plus the 0-based position of each row in ``order_cols`` order.

    ``order_cols`` must identify rows uniquely; otherwise tied rows could be
    numbered differently by a retried task.  ``keep`` (default: all): the
    columns that are still wanted once the order is known; only they are written.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in order_cols]
    # The ids depend on sampled range bounds; both consumers (counts and
    # numbering) must read one materialization of them.
    tagged = freeze(df.repartitionByRange(n, *keys)
                    .sortWithinPartitions(*keys)
                    .select(*([F.col(f"`{c}`") for c in keep] if keep is not None else ["*"]),
                            F.monotonically_increasing_id().alias(_MID)))
    tagged = (tagged.withColumn(_PART, F.shiftright(F.col(_MID), _LOCAL_BITS))
              .withColumn(_LOCAL, F.col(_MID).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    counts = tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    # offsets: one row per partition of the range sort -> bounded broadcast.
    return (tagged.join(F.broadcast(offsets), _PART)
            .withColumn(pos_col, (F.col(_OFF) + F.col(_LOCAL)).cast("long"))
            .drop(_MID, _PART, _LOCAL, _OFF))


def assign_chunks(df: DataFrame, order_cols: Sequence[str], chunk_size: int,
                  chunk_col: str = "chunk_id", pos_col: str = "row_pos",
                  keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus ``row_pos`` and ``chunk_id = row_pos // chunk_size``.

    Chunks are consecutive in ``order_cols`` order; every chunk holds
    ``chunk_size`` rows except a shorter last one.
    """
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    positioned = with_row_position(df, order_cols, pos_col, keep=keep)
    return positioned.withColumn(chunk_col,
                                 F.floor(F.col(pos_col) / F.lit(chunk_size)).cast("long"))


def chunk_progress(chunked: DataFrame, chunk_size: int, chunk_col: str = "chunk_id",
                   pos_col: str = "row_pos") -> DataFrame:
    """Per chunk: number (1-based), total chunks, start/end position, size, percent done.

    The grand total is a scalar subquery, summed over the per-chunk rows (one per chunk),
    which are frozen, so the numbered rows are read once and no task holds all chunks.
    """
    per = freeze(chunked.groupBy(chunk_col).agg(
        F.count(F.lit(1)).alias("size"),
        F.min(pos_col).alias("start"),
        (F.max(pos_col) + F.lit(1)).alias("end"),
    ))
    total = per.agg(F.sum("size")).scalar()
    return per.select(
        (F.col(chunk_col) + F.lit(1)).alias("chunk_number"),
        ceil_div(total, chunk_size).alias("total_chunks"),
        F.col("start"),
        F.col("end"),
        F.col("size"),
        percent_of(F.col("end"), total, 1).alias("progress_pct"),
    )
