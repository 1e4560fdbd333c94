"""PatId1 / UPGRADE: busy customers of big merchants whose importance is low.

For each merchant with more than ``threshold`` transactions, report the
customers whose percent rank by transaction count (descending) is
``<= top_pct`` and whose percent rank by average importance weight
(ascending) is ``<= low_pct``.

Every function takes and returns DataFrames.  The only jobs started while a
plan is built are the materializations of :func:`ledgerlift.session.freeze`.  The ``scope`` argument
prefixes every grouping key: ``scope=()`` is one detection over the whole
input, ``scope=["chunk_id"]`` runs the detection independently per input
file/chunk -- all chunks in one distributed job.

Plan shape of :func:`pattern_matches` (the shuffles are what scale):

1. transactions -> (scope, customer, merchant) counts: one hash shuffle with
   map-side partial aggregation, so a hot customer/merchant is combined
   before it moves.
2. merchant totals are summed from those pair counts (no second pass over
   transactions); eligible merchants are a LEFT SEMI join, not a list
   collected to the driver for ``isin``.
3. the customer weight is the mean of the customer's importance rows
   (default 1.0): importance is aggregated per customer *before* joining, so
   the pair rows never fan out over importance rows.
4. the scored pairs (eligible merchants only) are materialized once; both
   rank cuts come from :func:`ledgerlift.operators.rank.rank_cut`, one row
   per merchant, exact and skew-safe; the final step is a single join of the
   pairs with that per-merchant table and a range filter.
With ``method="window"`` steps 2 and 4 are windows over one shuffle by (scope, merchant)
and nothing is materialized: for scopes whose groups are bounded, such as chunks.
AQE decides at runtime whether the per-customer and per-merchant tables are
small enough to broadcast; otherwise they are sort-merge joined with skew
splitting.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.functions.columns import (
    ACTION_TYPE,
    PATTERN_ID,
    detection_time_string,
    weight_or_default,
)
from ledgerlift.operators.rank import passes_cut, percent_rank_within, percent_ranks_by_window, rank_cut
from ledgerlift.session import freeze

DEFAULT_THRESHOLD = 50_000
DEFAULT_TOP_PCT = 0.1
DEFAULT_LOW_PCT = 0.1

_CUSTOMER_WEIGHT = "__ll_customer_weight"
_SOURCE = "__ll_source"


def _scope(scope: str | Iterable[str] | None) -> list[str]:
    if scope is None:
        return []
    return [scope] if isinstance(scope, str) else list(scope)


def _count_method(method: str) -> str:
    # A merchant with R transactions has at most sqrt(2R) distinct customer
    # counts, so the histogram window is bounded per task: no hot-group probe.
    return "histogram" if method == "auto" else method


def customer_pairs(transactions: DataFrame, scope=()) -> DataFrame:
    """(scope..., customer, merchant, transaction_count)."""
    s = _scope(scope)
    return (transactions.groupBy(*s, "customer", "merchant")
            .agg(F.count(F.lit(1)).alias("transaction_count")))


def customer_weights(importance: DataFrame) -> DataFrame:
    """Mean importance weight per customer (NULL weights count as 1.0).

    Joining raw transactions to importance rows on ``customer = Source`` and
    averaging per (customer, merchant) gives each importance row the same
    multiplicity, so the mean depends on the customer only; aggregating first
    gives the same value without the fan-out.
    """
    return (importance.groupBy("Source")
            .agg(F.avg(weight_or_default("Weight")).alias(_CUSTOMER_WEIGHT)))


def with_avg_weight(pairs: DataFrame, importance: DataFrame) -> DataFrame:
    """``pairs`` plus ``avg_weight``; customers without importance get 1.0."""
    weights = customer_weights(importance).withColumnRenamed("Source", _SOURCE)
    joined = pairs.join(weights, F.col("customer") == F.col(_SOURCE), "left")
    return joined.select(*[F.col(c) for c in pairs.columns],
                         weight_or_default(_CUSTOMER_WEIGHT).alias("avg_weight"))


def customer_stats(transactions: DataFrame, scope=(), method: str = "auto") -> DataFrame:
    """Per (customer, merchant): transaction_count and merchant_rank.

    merchant_rank = percent_rank over the merchant's customers by count, descending.
    """
    s = _scope(scope)
    pairs = customer_pairs(transactions, s)
    return percent_rank_within(pairs, [*s, "merchant"], "transaction_count",
                               ascending=False, out_col="merchant_rank", method=method)


def importance_scores(transactions: DataFrame, importance: DataFrame, scope=(),
                      method: str = "auto", slices: int | None = None) -> DataFrame:
    """Per (customer, merchant): avg_weight and weight_rank (ascending)."""
    s = _scope(scope)
    pairs = customer_pairs(transactions, s).drop("transaction_count")
    return percent_rank_within(with_avg_weight(pairs, importance), [*s, "merchant"], "avg_weight",
                               ascending=True, out_col="weight_rank", method=method, slices=slices)


def merchant_totals(transactions: DataFrame, scope=()) -> DataFrame:
    """(scope..., merchant, total_transactions)."""
    s = _scope(scope)
    return (transactions.groupBy(*s, "merchant")
            .agg(F.count(F.lit(1)).alias("total_transactions")))


def eligible_merchants(transactions: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                       scope=()) -> DataFrame:
    """Merchants with strictly more than ``threshold`` transactions."""
    return merchant_totals(transactions, scope).filter(
        F.col("total_transactions") > F.lit(threshold))


def eligible_customer_stats(transactions: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                            scope=(), method: str = "auto") -> DataFrame:
    """customer_stats restricted to eligible merchants (semi-join, no collect)."""
    s = _scope(scope)
    keys = [*s, "merchant"]
    pairs = customer_pairs(transactions, s)
    totals = pairs.groupBy(*keys).agg(F.sum("transaction_count").alias("total_transactions"))
    eligible = totals.filter(F.col("total_transactions") > F.lit(threshold)).select(*keys)
    kept = pairs.join(eligible, keys, "left_semi")
    # Ranks are per merchant, so dropping whole merchants first changes no rank.
    return percent_rank_within(kept, keys, "transaction_count", ascending=False,
                               out_col="merchant_rank", method=method)


def pattern_matches(transactions: DataFrame, importance: DataFrame,
                    threshold: int = DEFAULT_THRESHOLD, top_pct: float = DEFAULT_TOP_PCT,
                    low_pct: float = DEFAULT_LOW_PCT, scope=(),
                    method: str = "auto", slices: int | None = None) -> DataFrame:
    """(scope..., customer, merchant, transaction_count, avg_weight) of every match."""
    return matches_from_pairs(customer_pairs(transactions, scope), importance, threshold,
                              top_pct, low_pct, scope, method, slices)


def matches_from_pairs(pairs: DataFrame, importance: DataFrame,
                       threshold: int = DEFAULT_THRESHOLD, top_pct: float = DEFAULT_TOP_PCT,
                       low_pct: float = DEFAULT_LOW_PCT, scope=(),
                       method: str = "auto", slices: int | None = None) -> DataFrame:
    """:func:`pattern_matches` starting from (scope..., customer, merchant,
    transaction_count) -- e.g. counts summed over many stream batches."""
    s = _scope(scope)
    keys = [*s, "merchant"]
    if method == "window":
        return _matches_by_window(pairs, importance, threshold, top_pct, low_pct, s)
    totals = pairs.groupBy(*keys).agg(F.sum("transaction_count").alias("total_transactions"))
    # one row per eligible merchant: the inner join keeps pairs of eligible
    # merchants only (a semi join) and carries the merchant total along
    eligible = totals.filter(F.col("total_transactions") > F.lit(threshold))
    # Read three times below (two rank cuts, final filter): compute it once.
    scored = freeze(with_avg_weight(pairs.join(eligible, keys, "inner"), importance), "scored-pairs")

    busiest = rank_cut(scored, keys, "transaction_count", ascending=False,
                       max_pct=top_pct, cut_col="__ll_min_count", method=_count_method(method))
    lightest = rank_cut(scored, keys, "avg_weight", ascending=True,
                        max_pct=low_pct, cut_col="__ll_max_weight", method=method, slices=slices)
    cuts = busiest.join(lightest, keys, "inner")
    matched = (scored.join(cuts, keys, "inner")
               .filter(passes_cut(F.col("transaction_count"), F.col("__ll_min_count"), False)
                       & passes_cut(F.col("avg_weight"), F.col("__ll_max_weight"), True)
                       # the customer side of the final equi-join drops NULL customers
                       & F.col("customer").isNotNull()))
    return matched.select(*s, "customer", "merchant", "transaction_count", "avg_weight")


def _matches_by_window(pairs: DataFrame, importance: DataFrame, threshold: int, top_pct: float,
                       low_pct: float, s: list[str]) -> DataFrame:
    """:func:`matches_from_pairs` where every (scope, merchant) fits a task: the pairs move once
    to their weight and once to their group, where total and both ranks are windows."""
    keys = [*s, "merchant"]
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])  # NULL is no group
    total = F.sum("transaction_count").over(Window.partitionBy(*keys))
    eligible = (with_avg_weight(pairs.filter(named), importance).withColumn("__ll_total", total)
                .filter(F.col("__ll_total") > F.lit(threshold)))
    ranked = percent_ranks_by_window(eligible, keys, [("transaction_count", False, "__ll_busy"),
                                                      ("avg_weight", True, "__ll_light")])
    matched = ranked.filter((F.col("__ll_busy") <= F.lit(top_pct)) & (F.col("__ll_light") <= F.lit(low_pct))
                            & F.col("customer").isNotNull())
    return matched.select(*s, "customer", "merchant", "transaction_count", "avg_weight")


def detection_records(matches: DataFrame, detected_at: str | None = None, scope=(),
                      pattern_id: str = PATTERN_ID, action_type: str = ACTION_TYPE) -> DataFrame:
    """Detections: YStartTime, detectionTime, patternId, ActionType, customer, merchant.

    Both time columns carry one driver-side time string per batch.
    """
    s = _scope(scope)
    stamp = detected_at if detected_at is not None else detection_time_string()
    return matches.select(
        F.lit(stamp).alias("YStartTime"),
        F.lit(stamp).alias("detectionTime"),
        F.lit(pattern_id).alias("patternId"),
        F.lit(action_type).alias("ActionType"),
        F.col("customer").cast("string").alias("customer"),
        F.col("merchant").cast("string").alias("merchant"),
        *[F.col(c) for c in s],
    )


def detect_upgrades(transactions: DataFrame, importance: DataFrame,
                    threshold: int = DEFAULT_THRESHOLD, top_pct: float = DEFAULT_TOP_PCT,
                    low_pct: float = DEFAULT_LOW_PCT, detected_at: str | None = None,
                    scope=(), method: str = "auto", slices: int | None = None) -> DataFrame:
    """Full PatId1: transactions + importance -> detection records.

    An empty input, or one without eligible merchants, yields an empty frame
    with the detection schema.
    """
    matches = pattern_matches(transactions, importance, threshold, top_pct, low_pct,
                              scope, method, slices)
    return detection_records(matches, detected_at, scope)
