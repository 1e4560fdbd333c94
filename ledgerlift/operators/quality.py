"""Data-quality report and valid / reject split for transactions.

The rules are ours (the source system only claims "validation and cleaning"):
a transaction is rejected when its customer or merchant is missing, its
amount is missing or negative, or its step is negative.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reject_reason(df: DataFrame) -> Column:
    """First failing rule as text, NULL for a valid row."""
    cols = set(df.columns)
    rules = [
        ("missing_customer", F.col("customer").isNull()),
        ("missing_merchant", F.col("merchant").isNull()),
    ]
    if "amount" in cols:
        rules += [("missing_amount", F.col("amount").isNull()),
                  ("negative_amount", F.col("amount") < 0)]
    if "step" in cols:
        rules.append(("negative_step", F.col("step") < 0))
    expr = F.lit(None).cast("string")
    for name, cond in reversed(rules):
        expr = F.when(cond, F.lit(name)).otherwise(expr)
    return expr


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``) -- two lazy filters."""
    tagged = df.withColumn("reject_reason", reject_reason(df))
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))


def quality_report(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """One row of counts, and of rows beyond the first per key, in one pass.

    Rows are counted per key first (partially aggregated); every other number
    is then a sum, minimum or maximum over the keys' partial results.
    """
    reason = reject_reason(df)
    counts = {
        "total_rows": F.lit(True),
        "valid_rows": reason.isNull(),
        "rejected_rows": reason.isNotNull(),
        "null_customer": F.col("customer").isNull(),
        "null_merchant": F.col("merchant").isNull(),
    }
    ranges = []
    if "amount" in df.columns:
        counts |= {"null_amount": F.col("amount").isNull(), "negative_amount": F.col("amount") < 0}
        ranges.append("amount")
    if "step" in df.columns:
        ranges.append("step")
    per_key = df.groupBy(*[F.col(k).alias(f"__ll_k_{k}") for k in key_cols]).agg(
        *[F.count(F.when(cond, 1)).alias(name) for name, cond in counts.items()],
        *[fn(c).alias(f"{side}_{c}") for c in ranges for side, fn in (("min", F.min), ("max", F.max))])
    return per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in counts],
        *[fn(f"{side}_{c}").alias(f"{side}_{c}") for c in ranges for side, fn in (("min", F.min), ("max", F.max))],
        F.coalesce(F.sum(F.col("total_rows") - 1), F.lit(0)).cast("long").alias("duplicate_keys"))
