"""Number the rows of files in the order in which the files hold them, and cut chunks.

A scan cuts files into splits and packs splits into tasks; inside a split rows
come in file order.  So a row's place follows from (file, start of its split,
place inside the split), and only the number of rows of each split has to be
known to turn that into a global position:

1. *tag* -- ``_metadata`` gives file path and split start.  For Parquet
   ``_metadata.row_index`` is the place in the file itself.  For text formats
   the place is the row's place in its task (``monotonically_increasing_id``),
   less the least such place of the split.
2. *count* -- rows per split; no column of the file is needed for that.
3. *prefix sums* over that table (one row per split), in (path, start) order.
4. *positions* -- the offsets are joined back by (file, split): by broadcast
   while there are at most ``BROADCAST_SPLITS`` of them, else by a shuffle.

Rows are never sorted globally.  Splits depend on the files and on the
session's split settings; should they differ between the count and the reading
(another number of cores decides them unless
``spark.sql.files.minPartitionNum`` is set), a row without its offset is an
error, not a wrong position.

Defined results: files are taken in the order of their paths; empty files and
files with only a header give no rows; rows with nulls count like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.session import freeze

FILE = "__ll_file"
SPLIT = "__ll_split"
PLACE = "__ll_place"
ROWS = "__ll_split_rows"
BEFORE = "__ll_split_before"      # rows of earlier splits, of all files
LINE_BEFORE = "__ll_line_before"  # rows of earlier splits of the same file
FIRST = "__ll_split_first"        # least place of the split
_POS = "__ll_pos"
BROADCAST_SPLITS = 200_000        # a row is a path and four numbers: about 50 MB


def tag_source(df: DataFrame, row_index: bool = False) -> DataFrame:
    """``df`` (straight from a file scan) plus file, split start and place of every row.

    ``row_index=True`` (Parquet): the place is the row's index in its file, which counts as
    one split however it is read."""
    file = F.col("_metadata.file_path").alias(FILE)
    if row_index:
        return df.select("*", file, F.lit(0).cast("long").alias(SPLIT), F.col("_metadata.row_index").alias(PLACE))
    return df.select("*", file, F.col("_metadata.file_block_start").alias(SPLIT),
                     F.monotonically_increasing_id().alias(PLACE))


def split_offsets(tagged: DataFrame) -> DataFrame:
    """One row per split: its rows, its least place, and the rows before it (in all, in its file).

    A file's splits are summed on their own and the files one after the other, so a window
    holds one row per file or per split of a file.  Materialized (it is small)."""
    per = freeze(tagged.groupBy(FILE, SPLIT).agg(F.count(F.lit(1)).alias(ROWS), F.min(PLACE).alias(FIRST)),
                 "source-splits")
    earlier = (Window.unboundedPreceding, -1)
    files = per.groupBy(FILE).agg(F.sum(ROWS).alias("n"))
    files = files.select(FILE, F.coalesce(F.sum("n").over(Window.orderBy(FILE).rowsBetween(*earlier)),
                                          F.lit(0)).alias("before"))
    inside = F.sum(ROWS).over(Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(*earlier))
    per = per.withColumn(LINE_BEFORE, F.coalesce(inside, F.lit(0))).join(files, FILE)
    return freeze(per.select(FILE, SPLIT, ROWS, FIRST, LINE_BEFORE, (F.col("before") + F.col(LINE_BEFORE)).alias(BEFORE)),
                  "source-offsets")


def _few(offsets: DataFrame) -> bool:
    return offsets.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS


def with_split_offsets(tagged: DataFrame, offsets: DataFrame, small: bool | None = None) -> DataFrame:
    """``tagged`` plus its split's row of ``offsets`` (``small``: they fit a broadcast)."""
    small = _few(offsets) if small is None else small
    out = tagged.join(F.broadcast(offsets) if small else offsets, [FILE, SPLIT], "left")
    known = F.when(F.col(BEFORE).isNull(), F.raise_error(F.lit("the splits of the source have changed")))
    return out.withColumn(BEFORE, known.otherwise(F.col(BEFORE)).cast("long"))


def _located(tagged: DataFrame, offsets: DataFrame, small: bool, row_index: bool) -> DataFrame:
    """``tagged`` plus its split's offsets and ``_POS``."""
    first = F.lit(0) if row_index else F.col(FIRST)  # a row index counts from the file's start
    return with_split_offsets(tagged, offsets, small).withColumn(_POS, (F.col(BEFORE) + F.col(PLACE) - first).cast("long"))


def with_source_position(df: DataFrame, pos_col: str = "row_pos", row_index: bool = False,
                         line_col: str | None = None, file_col: str | None = None) -> DataFrame:
    """``df`` (a file scan) plus each row's 0-based position in source order.

    ``line_col`` adds the place within the file, ``file_col`` the path.  The counting job runs
    while the plan is built; the result is a scan and a broadcast join, without any shuffle."""
    tagged = tag_source(df, row_index)
    offsets = split_offsets(tagged)
    located = _located(tagged, offsets, _few(offsets), row_index)
    extra = [F.col(_POS).alias(pos_col)]
    if line_col:
        extra.append((F.col(_POS) - F.col(BEFORE) + F.col(LINE_BEFORE)).alias(line_col))
    if file_col:
        extra.append(F.col(FILE).alias(file_col))
    return located.select(*[F.col(f"`{c}`") for c in df.columns], *extra)


def assign_source_chunks(df: DataFrame, chunk_size: int, chunk_col: str = "chunk_id",
                         pos_col: str = "row_pos", row_index: bool = False) -> DataFrame:
    """``df`` plus ``row_pos`` and ``chunk_id = row_pos // chunk_size``, in source order."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    out = with_source_position(df, pos_col, row_index)
    return out.withColumn(chunk_col, _chunk(F.col(pos_col), chunk_size))


def _chunk(pos: Column, chunk_size: int) -> Column:
    return F.floor(pos / F.lit(chunk_size)).cast("long")


def write_source_chunks(df: DataFrame, path: str, chunk_size: int, mode: str = "append",
                        row_index: bool = False) -> None:
    """One CSV file (with header) per ``chunk_size`` consecutive rows of the source files.

    A chunk that lies whole within one split is written by the task that reads the split: the
    rows before it that such a task writes are whole chunks too, so ``maxRecordsPerFile`` rolls
    a file at each chunk boundary.  Only rows of chunks that straddle splits (less than two
    chunks per split) and of the last, shorter chunk are shuffled, by range of their chunk.
    The source is read three times: for the counts (no columns), the whole chunks, the others.
    """
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    tagged = tag_source(df, row_index)
    # Parquet row indexes number a file; its tasks start anywhere in it
    offsets = split_offsets(tagged)
    small = _few(offsets)
    located = _located(tagged, offsets, small, row_index).withColumn("__ll_chunk", _chunk(F.col(_POS), chunk_size))
    start = F.col("__ll_chunk") * chunk_size
    whole = (start >= F.col(BEFORE)) & (start + chunk_size <= F.col(BEFORE) + F.col(ROWS))
    columns = [F.col(f"`{c}`") for c in df.columns]
    # rows keep their split's order only where nothing has moved them
    moved = located.filter(~whole) if small and not row_index else located
    out = (moved.repartitionByRange("__ll_chunk").sortWithinPartitions(_POS).select(*columns))
    if small and not row_index:
        out = located.filter(whole).select(*columns).union(out)
    out.write.mode(mode).option("maxRecordsPerFile", chunk_size).option("header", "true").csv(path)
