"""File sources: transaction / importance CSV landing files.

* explicit schemas (no ``inferSchema`` pass; streams require one anyway);
* ``strip_quotes=True`` reads values wrapped in single quotes ('C123') as bare
  values -- without it the quotes stay part of the data and quoted ids never
  match unquoted ids;
* bad rows: ``mode="PERMISSIVE"`` with an optional corrupt-record column,
  ``"DROPMALFORMED"`` or ``"FAILFAST"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift import schemas
from ledgerlift.functions.columns import name_contains


def csv_options(strip_quotes: bool = False, mode: str = "PERMISSIVE",
                corrupt_col: str | None = None) -> dict:
    # enforceSchema=false: the header must name the schema's columns in order;
    # a file laid out differently fails instead of being read positionally.
    opts = {"header": "true", "mode": mode, "enforceSchema": "false"}
    if strip_quotes:
        opts["quote"] = "'"
    if corrupt_col:
        opts["columnNameOfCorruptRecord"] = corrupt_col
    return opts


def _with_corrupt(schema: T.StructType, corrupt_col: str | None) -> T.StructType:
    if not corrupt_col:
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType(), True)])


def read_transactions_csv(spark: SparkSession, path: str | list[str], strip_quotes: bool = False,
                          mode: str = "PERMISSIVE", corrupt_col: str | None = None,
                          schema: T.StructType = schemas.TRANSACTIONS) -> DataFrame:
    return (spark.read.schema(_with_corrupt(schema, corrupt_col))
            .options(**csv_options(strip_quotes, mode, corrupt_col)).csv(path))


def read_importance_csv(spark: SparkSession, path: str | list[str], strip_quotes: bool = False,
                        mode: str = "PERMISSIVE") -> DataFrame:
    """Importance rows by header name: extra columns are dropped and columns may be in any
    order; a missing one stays missing (see ``sources.dimension.importance_chain``)."""
    options = csv_options(strip_quotes, mode)
    header = spark.read.options(**options).csv(path).columns  # reads the first line
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    known = {f.name: f.dataType for f in schemas.IMPORTANCE.fields}
    rows = spark.read.schema(T.StructType([T.StructField(f.name, known.get(f.name, f.dataType))
                                           for f in as_text.fields])).options(**options).csv(path)
    return rows.select(*[c for c in schemas.IMPORTANCE.fieldNames() if c in header])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, length, modified) of the files directly under ``folder``.

    Uses Spark's binary-file source with the content column pruned, so only
    the file listing is read -- on any Hadoop file system, paginated by the
    file system client.
    """
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "false")
          .load(folder)
          .select("path", "length", "modificationTime"))
    return df.select(
        F.col("path"),
        F.element_at(F.split(F.col("path"), "/"), -1).alias("name"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


def pick_role_file(spark: SparkSession, folder: str, needle: str) -> str:
    """Path of the file whose name contains ``needle`` (case-insensitive).

    Several matches: the last in name order wins.  No match is an error.
    The listing is metadata (one small row per file), not data.
    """
    listing = list_files(spark, folder).filter(name_contains("name", needle))
    row = listing.orderBy(F.col("name").desc()).select("path").first()
    if row is None:
        raise FileNotFoundError(f"no file matching {needle!r} under {folder}")
    return row["path"]


def load_landing_folder(spark: SparkSession, folder: str, strip_quotes: bool = False):
    """(transactions, importance) from a folder holding both CSV files."""
    tx_path = pick_role_file(spark, folder, "transactions.csv")
    imp_path = pick_role_file(spark, folder, "customerimportance.csv")
    return (read_transactions_csv(spark, tx_path, strip_quotes),
            read_importance_csv(spark, imp_path, strip_quotes))


# Time layouts seen in detection files: the one the detector writes and the
# day-first one found in exported samples.
DETECTION_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm")


def read_detections_csv(spark: SparkSession, path: str | list[str],
                        strip_quotes: bool = True) -> DataFrame:
    """Detection CSV files, plus ``detected_at`` parsed from ``detectionTime``.

    Exported samples wrap ids in single quotes ('C123'); ``strip_quotes``
    reads them bare.  Either time layout is accepted (first that parses).
    """
    df = (spark.read.schema(schemas.DETECTIONS)
          .options(**csv_options(strip_quotes)).csv(path))
    parsed = F.coalesce(*[F.try_to_timestamp(F.col("detectionTime"), F.lit(fmt))
                          for fmt in DETECTION_TIME_FORMATS])
    return df.withColumn("detected_at", parsed)
