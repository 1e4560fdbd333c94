"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.session import freeze, scratch_path

__all__ = ["freeze", "freeze_packed", "table", "partitions", "total_bytes", "bucket_count",
           "drop_frozen", "only", "scratch_path"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read with Spark's Parquet reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, under the operator's own names.

    ``only(df, doc="doc_id", text="text")``.  Every operator starts from such a
    projection, so extra columns of the input -- whatever they are called --
    can't clash with its intermediate columns.
    """
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def total_bytes(df: DataFrame, column: Column) -> int:
    """UTF-8 bytes of a text column over all rows (one aggregate, one number)."""
    row = df.agg(F.sum(F.octet_length(column))).first()
    return int(row[0] or 0)


def bucket_count(df: DataFrame, bytes_in: int, bytes_each: int = 8 << 20) -> int:
    """Buckets for packed shuffles: as many as keep each at about ``bytes_each``
    of source text, and no fewer than the session's shuffle partitions."""
    return max(partitions(df), -(-bytes_in // bytes_each))


def drop_frozen(*tables: DataFrame) -> None:
    """Deletes frozen tables that nothing reads any more (their results have been written)."""
    for df in tables:
        jvm, files = df.sparkSession._jvm, df.inputFiles()
        if files:
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def freeze_packed(df: DataFrame, name: str) -> DataFrame:
    """:func:`freeze` with zstd pages, for tables of hashes and packed arrays."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
