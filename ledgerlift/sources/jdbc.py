"""JDBC tables (the importance dimension and result tables may live in a database).

Only Spark's own JDBC data source is used.  Reads are parallel when a numeric
or date ``partition_column`` with bounds is given (one range query per
partition); otherwise one task reads the table, which is fine only for small
dimensions.  No test here talks to a database server (none may be started in
this environment); tests use Parquet tables instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(url: str, table: str, properties: dict | None = None,
                      partition_column: str | None = None, lower_bound=None, upper_bound=None,
                      num_partitions: int | None = None, fetch_size: int = 10_000) -> dict:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                    **partitioning) -> DataFrame:
    """``spark.read.format("jdbc")`` with optional range partitioning."""
    return spark.read.format("jdbc").options(
        **jdbc_read_options(url, table, properties, **partitioning)).load()


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 1_000, num_partitions: int | None = None) -> None:
    """Append ``df`` with batched inserts, one connection per task.

    ``num_partitions`` caps concurrent connections (Spark coalesces first).
    """
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**opts).mode("append").save()
