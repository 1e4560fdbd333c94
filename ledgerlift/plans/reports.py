"""Reports around the detection: merchant ranking, threshold advice, monthly stats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.columns import weight_or_default
from ledgerlift.plans.upgrade import DEFAULT_THRESHOLD, detect_upgrades, merchant_totals


def project_rename(transactions: DataFrame) -> DataFrame:
    """customer, merchant, transaction_type (= category)."""
    return transactions.select("customer", "merchant",
                               F.col("category").alias("transaction_type"))


def importance_join(transactions: DataFrame, importance: DataFrame) -> DataFrame:
    """Row-level LEFT JOIN on ``customer = Source`` with weight default 1.0.

    This is the literal fan-out join (one row per matching importance row);
    the detection plans never build it and aggregate importance first.
    """
    tx = transactions.select("customer", "merchant",
                             F.col("category").alias("transaction_type"))
    imp = importance.select(F.col("Source").alias("__ll_source"), F.col("Weight"))
    return (tx.join(imp, F.col("customer") == F.col("__ll_source"), "left")
            .select("customer", "merchant", "transaction_type",
                    weight_or_default("Weight").alias("weight")))


def top_merchants(transactions: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` merchants with most transactions (ties by merchant id).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
    its local top k, only k rows per task reach the final merge.
    """
    return (merchant_totals(transactions)
            .orderBy(F.col("total_transactions").desc(), F.col("merchant").asc())
            .limit(k))


def threshold_advice(transactions: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: merchants, eligible merchants and the largest merchant count.

    When no merchant is eligible, ``max_transactions`` is the count the
    threshold would have to stay below.
    """
    totals = merchant_totals(transactions)
    return totals.agg(
        F.count(F.lit(1)).alias("total_merchants"),
        F.count(F.when(F.col("total_transactions") > F.lit(threshold), 1)).alias("eligible_merchants"),
        F.coalesce(F.max("total_transactions"), F.lit(0)).cast("long").alias("max_transactions"),
        F.lit(threshold).cast("long").alias("threshold"),
    )


def with_month(transactions: DataFrame, date_col: str = "order_date",
               month_col: str = "month") -> DataFrame:
    """Adds the calendar month as an integer key ``yyyymm`` (cheap to build,
    hash and sort, unlike a formatted string per row)."""
    d = F.col(date_col)
    return transactions.withColumn(month_col, F.year(d) * 100 + F.month(d))


def month_label(month_key: str = "month") -> Column:
    """``yyyymm`` key -> ``yyyy-MM`` text."""
    k = F.col(month_key)
    return F.format_string("%04d-%02d", F.floor(k / 100).cast("int"), (k % 100).cast("int"))


def monthly_detections(transactions: DataFrame, importance: DataFrame, threshold: int,
                       detected_at: str | None = None, date_col: str = "order_date",
                       method: str = "auto") -> DataFrame:
    """PatId1 run independently for every calendar month of transactions
    (``month`` column: ``yyyymm`` key)."""
    return detect_upgrades(with_month(transactions, date_col), importance, threshold,
                           detected_at=detected_at, scope=["month"], method=method)


def monthly_detection_stats(detections: DataFrame, month_col: str = "month") -> DataFrame:
    """Per (month, patternId, merchant): detections and distinct customers;
    ``month`` as ``yyyy-MM`` text."""
    return (detections.groupBy(month_col, "patternId", "merchant")
            .agg(F.count(F.lit(1)).alias("detections"),
                 F.countDistinct("customer").alias("customers"))
            .withColumn(month_col, month_label(month_col)))
