"""Keyed tables whose versions share files: copy-on-write of touched key buckets only.

A group of tables is cut into buckets by a hash of each table's bucket columns.
A version is a manifest -- for every table and bucket, the version that wrote
its files -- and becomes current when that manifest is committed:

    <root>/data/<table>/version=<v>/bucket=<b>/*.parquet
    <root>/manifest/version=<v>/          (table, bucket, at)

A commit writes new files for the touched buckets and one manifest; all other
buckets keep their files.  Tables of one group switch together.  A reader
resolves a version first, so it sees the old or the new one, never a mixture;
:meth:`VersionedTables.publish` makes the same switch for SQL readers with a
single ``CREATE OR REPLACE VIEW``.  A commit that is repeated under its version
number (a retried stream batch) starts from the same base and overwrites its
own files.  One writer at a time.

At most ``buckets`` rows per table reach the driver (bucket numbers and the
manifest).  A bucket's rows are written by as many tasks as its size asks for
(AQE splits large ones), so a hot key is not one task.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.operators.merge import upsert

BUCKET = "bucket"
NO_VERSION = -1  # as of before the first commit: tables without rows
_MANIFEST = T.StructType([T.StructField("table", T.StringType()), T.StructField("bucket", T.IntegerType()),
                          T.StructField("at", T.LongType())])


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark knows; none if it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class VersionedTables:
    """``tables``: name -> (schema as DDL, bucket columns)."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, tuple[str, Sequence[str]]],
                 buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.schemas = {name: T._parse_datatype_string(ddl) for name, (ddl, _) in tables.items()}
        self.bucket_by = {name: list(columns) for name, (_, columns) in tables.items()}

    # -- versions -----------------------------------------------------------
    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/version={version}"

    def _data_path(self, table: str, version: int) -> str:
        return f"{self.root}/data/{table}/version={version}"

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = [int(name.partition("=")[2]) for name in children(self.spark, f"{self.root}/manifest")
                 if name.startswith("version=")]
        return sorted(v for v in found if "_SUCCESS" in children(self.spark, self._manifest_path(v)))

    def latest(self, before: int | None = None) -> int:
        """The newest committed version (before another); ``NO_VERSION`` if there is none."""
        return max((v for v in self.versions() if before is None or v < before), default=NO_VERSION)

    def manifest(self, version: int) -> dict[tuple[str, int], int]:
        """(table, bucket) -> the version that wrote it; notes have bucket -1."""
        if version == NO_VERSION:
            return {}
        rows = self.spark.read.schema(_MANIFEST).parquet(self._manifest_path(version)).collect()
        return {(r["table"], r["bucket"]): r["at"] for r in rows}

    def note(self, name: str, version: int) -> int | None:
        """A number that a commit left beside its tables."""
        return self.manifest(version).get((name, -1))

    # -- reading ------------------------------------------------------------
    def bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by[table]), F.lit(self.buckets)).cast("int")

    def touched(self, table: str, keys: DataFrame) -> list[int]:
        """The buckets of a frame that has the table's bucket columns."""
        return sorted(r[0] for r in keys.select(self.bucket(table).alias("b")).distinct().collect())

    def paths(self, table: str, version: int, only: Iterable[int] | None = None) -> list[str]:
        only = None if only is None else set(only)
        return [f"{self._data_path(name, at)}/{BUCKET}={b}" for (name, b), at in sorted(self.manifest(version).items())
                if name == table and b >= 0 and (only is None or b in only)]

    def read(self, table: str, version: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """A table as of a version (default: the current one), of some buckets only if named."""
        version = self.latest() if version is None else version
        paths = self.paths(table, version, only)
        schema = self.schemas[table]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- writing ------------------------------------------------------------
    def commit(self, contents: Mapping[str, tuple[DataFrame, Iterable[int]]], version: int,
               notes: Mapping[str, int] | None = None, arranged: Iterable[str] = ()) -> int:
        """Writes ``table -> (all rows of the touched buckets, those buckets)`` as a version.

        ``arranged``: tables whose rows already lie together by bucket, in ranges or in files of
        their own; they are written where they are, the others are shuffled by bucket.  Rows outside the touched buckets are an error.  The base is the newest version before."""
        entries = self.manifest(self.latest(before=version))
        for table, (rows, touched) in contents.items():
            touched = set(touched)
            names = self.schemas[table].fieldNames()
            own = self.bucket(table)
            outside = ~own.isin(sorted(touched)) if touched else F.lit(True)
            rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schemas[table].fields]).withColumn(
                BUCKET, F.when(outside, F.raise_error(F.lit(f"{table}: a row outside the touched buckets")))
                .otherwise(own).cast("int"))
            path = self._data_path(table, version)
            rows = rows if table in arranged else rows.hint("rebalance", BUCKET)
            (rows.sortWithinPartitions(BUCKET, *self.bucket_by[table])
             .select(*names, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path))
            written = {int(n.partition("=")[2]) for n in children(self.spark, path) if n.startswith(f"{BUCKET}=")}
            for b in touched:  # a bucket left without rows has no files
                entries.pop((table, b), None)
                if b in written:
                    entries[table, b] = version
        entries |= {(name, -1): value for name, value in (notes or {}).items()}
        rows = [(name, b, at) for (name, b), at in sorted(entries.items())]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite") \
            .parquet(self._manifest_path(version))
        return version

    def upsert(self, table: str, updates: DataFrame, keys: Sequence[str], version: int | None = None,
               as_of=None) -> int:
        """``INSERT ... ON CONFLICT (keys) DO UPDATE`` as a new version; gives its number.

        The bucket columns must be among the keys.  Only buckets with an updated key are read
        and written; ``created_at`` / ``updated_at`` are kept and set if the table has them."""
        if not set(self.bucket_by[table]) <= set(keys):
            raise ValueError(f"the bucket columns of {table} must be keys")
        base = self.latest(before=version)
        version = base + 1 if version is None else version
        touched = self.touched(table, updates)
        names = self.schemas[table].fieldNames()
        stamps = {c: c if c in names else None for c in ("created_at", "updated_at")}
        rows = upsert(self.read(table, base, touched), updates, keys, as_of=as_of,
                      created_col=stamps["created_at"], updated_col=stamps["updated_at"])
        return self.commit({table: (rows, touched)}, version)

    def publish(self, table: str, view: str, version: int | None = None) -> None:
        """Points a view at a version: one catalog operation, so its readers see one version whole.

        The view unites the live files by the version that wrote them, each with its buckets."""
        version = self.latest() if version is None else version
        by_version: dict[int, list[int]] = {}
        for (name, b), at in sorted(self.manifest(version).items()):
            if name == table and b >= 0:
                by_version.setdefault(at, []).append(b)
        columns = ", ".join(f"`{c}`" for c in self.schemas[table].fieldNames())
        parts = [f"SELECT {columns} FROM parquet.`{self._data_path(table, at)}` WHERE {BUCKET} IN ({', '.join(map(str, b))})"
                 for at, b in by_version.items()]
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schemas[table].fields)
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + (" UNION ALL ".join(parts) or f"SELECT {none} WHERE false"))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forgets all but the newest ``keep`` versions and deletes files that none of them has."""
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = self.versions()
        live = {(name, at, b) for v in versions[-keep:] for (name, b), at in self.manifest(v).items()}
        gone = [self._manifest_path(v) for v in versions[:-keep]]
        newest = versions[-1] if versions else -1
        for table in self.schemas:
            for folder in children(self.spark, f"{self.root}/data/{table}"):
                at = int(folder.partition("=")[2])
                if at > newest:
                    continue  # a commit at work
                for name in children(self.spark, self._data_path(table, at)):
                    if name.startswith(f"{BUCKET}=") and (table, at, int(name.partition("=")[2])) not in live:
                        gone.append(f"{self._data_path(table, at)}/{name}")
        for path in gone:
            delete(self.spark, path)
        return gone
