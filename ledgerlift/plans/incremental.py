"""Merchant tables kept up to date batch by batch: only touched merchants are ranked again.

State (:class:`~ledgerlift.sinks.versioned.VersionedTables`, bucketed by merchant):
``customer_transaction_stats`` (D1), ``customer_importance_scores`` (D2),
``eligible_merchants`` (D3) and ``detections`` (the pairs of D6), each as of a batch.

A batch touches the merchants of its transactions.  All results of PatId1 are
per merchant, so for the others nothing changes: buckets without a touched
merchant are neither read nor written, and inside a touched bucket the rows of
other merchants are copied without being ranked.  Counts are keyed deltas (old
count + the batch's count).  If the importance table itself has changed since
the batch before -- told by a digest of its rows -- every merchant is touched.

What moves: a pair goes to its customer once (summed and weighed there) and to its
merchant once, where both ranks are windows; the partitions are ranges of (bucket,
merchant), so the tables are written from them as they lie.  Merchants that may have
more than ``WINDOW_PAIRS`` customers are ranked by slices instead.

A batch that runs again under its number starts from the same base and
overwrites its own files, so results don't depend on retries.

Defined results: a NULL merchant has statistics but is never eligible; a NULL
customer counts in ranks and is never detected; ``created_at`` is the batch
time that first wrote a row, ``updated_at`` that of the last batch that
touched its merchant; an empty batch commits a version with no new files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.operators.rank import join_null_safe, percent_rank_within, percent_ranks_by_window
from ledgerlift.plans.upgrade import (
    DEFAULT_LOW_PCT,
    DEFAULT_THRESHOLD,
    DEFAULT_TOP_PCT,
    customer_pairs,
    with_avg_weight,
)
from ledgerlift.session import freeze
from ledgerlift.sinks.versioned import BUCKET, NO_VERSION, VersionedTables

STATS, SCORES, ELIGIBLE, DETECTED = ("customer_transaction_stats", "customer_importance_scores",
                                     "eligible_merchants", "detections")
WINDOW_PAIRS = 1 << 18  # customers of a merchant that one task ranks
_RANKS = [("transaction_count", False, "merchant_rank"), ("avg_weight", True, "weight_rank")]
_STAMPS = "created_at TIMESTAMP, updated_at TIMESTAMP"


def importance_digest(importance: DataFrame) -> int:
    """One number that changes with the rows that decide the weights (Source, Weight)."""
    rows = importance.agg(F.count(F.lit(1)), F.sum(F.xxhash64("Source", "Weight").cast("decimal(20,0)")))
    return rows.select(F.xxhash64(*rows.columns)).first()[0]


class MerchantState:
    """The tables above under ``root``; ``apply`` takes one batch."""

    def __init__(self, spark: SparkSession, root: str, threshold: int = DEFAULT_THRESHOLD,
                 top_pct: float = DEFAULT_TOP_PCT, low_pct: float = DEFAULT_LOW_PCT, buckets: int = 256,
                 customer_type: str = "STRING", merchant_type: str = "STRING"):
        pair = f"customer {customer_type}, merchant {merchant_type}"
        by = ["merchant"]
        self.tables = VersionedTables(spark, root, {
            STATS: (f"{pair}, transaction_count BIGINT, merchant_rank DOUBLE, {_STAMPS}", by),
            SCORES: (f"{pair}, avg_weight DOUBLE, weight_rank DOUBLE, {_STAMPS}", by),
            ELIGIBLE: (f"merchant {merchant_type}, total_transactions BIGINT, {_STAMPS}", by),
            DETECTED: (pair, by)}, buckets)
        self.threshold, self.top_pct, self.low_pct = threshold, top_pct, low_pct

    def detections(self, version: int | None = None) -> DataFrame:
        """``customer, merchant`` of all detections as of a batch (default: the last)."""
        return self.tables.read(DETECTED, version)

    def apply(self, transactions: DataFrame, importance: DataFrame, version: int, as_of) -> tuple[DataFrame, DataFrame]:
        """Takes a batch; gives the pairs that are detected newly, and those that no longer are.

        ``as_of``: the batch's time stamp."""
        tables = self.tables
        base = tables.latest(before=version)
        now = F.lit(as_of).cast("timestamp")
        own = freeze(customer_pairs(transactions), "batch-pairs")
        digest = importance_digest(importance)
        whole = base != NO_VERSION and tables.note("importance", base) != digest
        touched = range(tables.buckets) if whole else tables.touched(STATS, own)

        def stored(table):
            return tables.read(table, base, touched)

        merchants = own.select("merchant").distinct()
        if whole:
            merchants = merchants.union(stored(STATS).select("merchant")).distinct()

        def split(table):
            """The touched merchants' rows, and the others of their buckets."""
            old = stored(table)
            return (join_null_safe(old, merchants, ["merchant"], "left_semi"),
                    join_null_safe(old, merchants, ["merchant"], "left_anti"))

        old_stats, kept_stats = split(STATS)
        # by customer only: sums per pair and the join with weights need no other shuffle, and
        # a customer has at most two rows per merchant here
        pairs = (own.select("customer", "merchant", "transaction_count", F.lit(None).cast("timestamp").alias("created_at"))
                 .unionByName(old_stats.select("customer", "merchant", "transaction_count", "created_at"))
                 .repartition("customer").groupBy("customer", "merchant")
                 .agg(F.sum("transaction_count").alias("transaction_count"),
                      F.coalesce(F.min("created_at"), now).alias("created_at")))
        weighted = with_avg_weight(pairs, importance).withColumn(BUCKET, tables.bucket(STATS))
        sizes = own.select("merchant").union(old_stats.select("merchant")).groupBy("merchant").count()
        large = freeze(sizes.filter(F.col("count") > WINDOW_PAIRS).select("merchant"), "batch-large")
        sliced = not large.isEmpty()
        if sliced:
            weighted = freeze(weighted, "batch-weighted")
            rest = join_null_safe(weighted, large, ["merchant"], "left_semi")
            weighted = join_null_safe(weighted, large, ["merchant"], "left_anti")
        ranked = percent_ranks_by_window(weighted.repartitionByRange(BUCKET, "merchant"), [BUCKET, "merchant"], _RANKS)
        if sliced:
            for column, ascending, rank in _RANKS:
                rest = percent_rank_within(rest, "merchant", column, ascending, rank)
            ranked = ranked.unionByName(rest)
        ranked = freeze(ranked.drop(BUCKET).withColumn("updated_at", now), "batch-ranked")

        old_eligible, kept_eligible = split(ELIGIBLE)
        totals = (ranked.groupBy("merchant").agg(F.sum("transaction_count").alias("total_transactions"))
                  .filter((F.col("total_transactions") > self.threshold) & F.col("merchant").isNotNull()))
        eligible = freeze(totals.join(old_eligible.select("merchant", "created_at"), "merchant", "left").select(
            "merchant", "total_transactions", F.coalesce("created_at", now).alias("created_at"),
            now.alias("updated_at")), "batch-eligible")

        old_found, kept_found = split(DETECTED)
        found = freeze(ranked.filter((F.col("merchant_rank") <= self.top_pct) & (F.col("weight_rank") <= self.low_pct)
                                     & F.col("customer").isNotNull())
                       .join(eligible.select("merchant"), "merchant", "left_semi")
                       .select("customer", "merchant"), "batch-found")

        def columns(table):
            return tables.schemas[table].fieldNames()

        tables.commit({
            STATS: (kept_stats.unionByName(ranked.select(*columns(STATS))), touched),
            SCORES: (split(SCORES)[1].unionByName(ranked.select(*columns(SCORES))), touched),
            ELIGIBLE: (kept_eligible.unionByName(eligible), touched),
            DETECTED: (kept_found.unionByName(found), touched)}, version, {"importance": digest},
            arranged=() if sliced else (STATS, SCORES))
        return (found.join(old_found, ["customer", "merchant"], "left_anti"),
                old_found.join(found, ["customer", "merchant"], "left_anti"))
