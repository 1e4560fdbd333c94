"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import contextvars
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan in this package is written against.  AQE is what turns
# a size-unknown shuffle join into a broadcast only after the build side has
# been measured, and what splits skewed sort-merge-join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlift", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the session the platform gives you."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session that leaves it unset (tests, a laptop) gets a
    private folder; on a cluster an unset value is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            # executors could not see a folder on the driver's disk
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ledgerlift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/ledgerlift/{name}-{uuid.uuid4().hex[:12]}"


_REUSE = contextvars.ContextVar("ledgerlift_reusable_scratch", default=None)


@contextmanager
def reusable_scratch(root: str):
    """Inside the block, :func:`freeze` writes to ``root/<name>-<n>`` (``n``
    counting from 0 within the block) with overwrite.

    For jobs that repeat, such as one stream micro-batch after another: each
    batch reuses the previous batch's folders, so scratch space stays bounded.
    Everything frozen inside the block must be consumed before it ends.
    """
    token = _REUSE.set([root.rstrip("/"), 0])
    try:
        yield
    finally:
        _REUSE.reset(token)


_PLANS = contextvars.ContextVar("ledgerlift_recorded_plans", default=None)


@contextmanager
def recorded_plans():
    """Inside the block, the plan of every :func:`freeze` is added to the list it gives
    (plans that have run are not part of the plan that reads their result)."""
    plans: list[str] = []
    token = _PLANS.set(plans)
    try:
        yield plans
    finally:
        _PLANS.reset(token)


def freeze(df, name: str = "frozen"):
    """Compute ``df`` once, write it as Parquet to the shared checkpoint folder,
    and continue from the written table (lineage cut).

    Used where a plan branches after a *sampled* range partitioning (two
    evaluations could sample different bounds, so ids derived from a partition
    index must come from one materialization) and where an expensive
    intermediate is read several times.  Living in ``spark.checkpoint.dir``,
    the table survives lost executors; one job, columnar, no recomputation.
    """
    spark = df.sparkSession
    if _PLANS.get() is not None:
        _PLANS.get().append(df._jdf.queryExecution().executedPlan().toString())
    reuse = _REUSE.get()
    if reuse is None:
        path = scratch_path(spark, name)
        df.write.parquet(path)
    else:
        path = f"{reuse[0]}/{name}-{reuse[1]}"
        reuse[1] += 1
        df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer-reading inference job over the part files
    return spark.read.schema(df.schema).parquet(path)
