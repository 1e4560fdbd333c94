"""Registered queries over the star-schema test tables, with equivalent SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables.  The
SQL strings are written independently in plain ANSI/DuckDB SQL (literal
window ``percent_rank``, ``ROW_NUMBER``, ``IN`` lists) and serve as oracles.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.operators.chunking import assign_chunks, chunk_progress
from ledgerlift.operators.merge import insert_if_absent, unprocessed, upsert
from ledgerlift.operators.quality import quality_report
from ledgerlift.operators.source_order import assign_source_chunks
from ledgerlift import schemas
from ledgerlift.plans import incremental, reports, upgrade
from ledgerlift.session import freeze, scratch_path
from ledgerlift.sinks.tables import table_counts
from ledgerlift.sinks.versioned import VersionedTables
from ledgerlift.sinks.writers import detection_batches
from ledgerlift.sources import tpch
from ledgerlift.sources.dimension import importance_chain
from ledgerlift.sources.quarantine import valid_or_reason

# Parameters of the registered queries (fixed; the library takes them as arguments).
THRESHOLD = 600            # mean transactions per merchant in the test tables
CHUNK_SIZE = 10_000        # rows per landing file
MONTH_THRESHOLD = 8        # per-month detection threshold
BATCH_SIZE = 50            # detections per output file
DETECTED_AT = "2025-01-01 00:00:00"
SPLIT_DATE = "1996-01-01"  # importance versions for upsert / insert-if-absent
ROW_KEY = tpch.ROW_KEY

Query = Callable[[SparkSession, str], DataFrame]


def _tx(spark, sf, with_category=False):
    return tpch.transactions(spark, sf, with_category=with_category)


def _imp(spark, sf):
    return tpch.customer_importance(spark, sf)


def _times_as_text(df):
    """Time columns as text, which both engines write alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
                           for c in ("order_date", "l_shipdate") if c in df.columns})


def q_scan_transactions(spark, sf):
    return _times_as_text(_tx(spark, sf, True))


def q_scan_importance(spark, sf):
    return _imp(spark, sf)


def q_project_rename(spark, sf):
    return reports.project_rename(_tx(spark, sf, True))


def q_importance_join(spark, sf):
    return reports.importance_join(_tx(spark, sf, True), _imp(spark, sf))


def q_customer_stats(spark, sf):
    return upgrade.customer_stats(_tx(spark, sf))


def _rounded(df, col="avg_weight"):
    """Means to six places: engines differ in the last bit of a sum of doubles."""
    return df.withColumn(col, F.round(col, 6))


def q_importance_scores(spark, sf):
    return _rounded(upgrade.importance_scores(_tx(spark, sf), _imp(spark, sf)))


def q_merchant_counts(spark, sf):
    return upgrade.merchant_totals(_tx(spark, sf))


def q_eligible_merchants(spark, sf):
    return upgrade.eligible_merchants(_tx(spark, sf), THRESHOLD)


def q_top_merchants(spark, sf):
    return reports.top_merchants(_tx(spark, sf), 5)


def q_threshold_advice(spark, sf):
    return reports.threshold_advice(_tx(spark, sf), upgrade.DEFAULT_THRESHOLD)


def q_eligible_stats(spark, sf):
    return upgrade.eligible_customer_stats(_tx(spark, sf), THRESHOLD)


def q_pattern_matches(spark, sf):
    return _rounded(upgrade.pattern_matches(_tx(spark, sf), _imp(spark, sf), THRESHOLD))


def q_detections(spark, sf):
    return upgrade.detect_upgrades(_tx(spark, sf), _imp(spark, sf), THRESHOLD,
                                   detected_at=DETECTED_AT)


def q_detect_upgrades(spark, sf):
    # top 20% busiest and bottom 20% lightest at a lower volume bar
    return upgrade.detect_upgrades(_tx(spark, sf), _imp(spark, sf), 550, top_pct=0.2,
                                   low_pct=0.2, detected_at=DETECTED_AT)


HOT_MERCHANT = -1          # merchant id that takes over a third of all lines
HOT_SLICES = 16            # range slices of the weight rank: the hot merchant spans several


def hot_merchant_transactions(spark, sf):
    """Every line of a supplier whose key is divisible by 3 is booked under one
    marketplace merchant: one merchant then holds about a third of all rows.
    No row is dropped; only the merchant id changes."""
    tx = _tx(spark, sf)
    return tx.withColumn("merchant", F.when(F.col("merchant") % 3 == 0, F.lit(HOT_MERCHANT))
                         .otherwise(F.col("merchant")))


def q_detect_upgrades_hot_merchant(spark, sf):
    return upgrade.detect_upgrades(hot_merchant_transactions(spark, sf), _imp(spark, sf),
                                   THRESHOLD, detected_at=DETECTED_AT, slices=HOT_SLICES)


def q_importance_scores_hot_merchant(spark, sf):
    return _rounded(upgrade.importance_scores(hot_merchant_transactions(spark, sf), _imp(spark, sf),
                                              slices=HOT_SLICES))


def chunk_threshold(spark, sf):
    """The mean number of transactions per chunk and merchant: larger merchants are eligible."""
    return CHUNK_SIZE // max(1, tpch.table(spark, sf, "supplier").count())


def q_detect_upgrades_per_chunk(spark, sf):
    # only the detection columns go into the chunk table; a merchant of a chunk fits a window
    chunked = assign_chunks(_tx(spark, sf).select(*ROW_KEY, "customer"), ROW_KEY, CHUNK_SIZE,
                            keep=["customer", "merchant"])
    return upgrade.detect_upgrades(chunked, _imp(spark, sf), chunk_threshold(spark, sf),
                                   detected_at=DETECTED_AT, scope=["chunk_id"], method="window")


def q_chunk_assignment(spark, sf):
    return _times_as_text(assign_chunks(_tx(spark, sf).select(*ROW_KEY), ROW_KEY, CHUNK_SIZE))


def q_source_chunks(spark, sf):
    """Lines numbered and cut into chunks in the order in which the file holds them."""
    lines = assign_source_chunks(tpch.table(spark, sf, "lineitem"), CHUNK_SIZE, row_index=True)
    return _times_as_text(lines)


def q_detect_upgrades_per_source_chunk(spark, sf):
    # chunks as the source file has them, not in the order of a key
    lines = assign_source_chunks(tpch.table(spark, sf, "lineitem"), CHUNK_SIZE, row_index=True)
    tx = tpch.transactions(spark, sf, lines=lines, keep=["chunk_id"])
    return upgrade.detect_upgrades(tx, _imp(spark, sf), chunk_threshold(spark, sf),
                                   detected_at=DETECTED_AT, scope=["chunk_id"], method="window")


def q_chunk_progress(spark, sf):
    return chunk_progress(assign_chunks(_tx(spark, sf).select(*ROW_KEY), ROW_KEY, CHUNK_SIZE),
                          CHUNK_SIZE)


def q_detection_batches(spark, sf):
    return detection_batches(q_detections(spark, sf), BATCH_SIZE)


def q_upsert_importance(spark, sf):
    old = tpch.customer_importance(spark, sf, before=SPLIT_DATE)
    new = tpch.customer_importance(spark, sf, since=SPLIT_DATE)
    return upsert(old, new, ["Source", "typeTrans"], created_col=None, updated_col=None,
                  state_col="row_state")


STAMPS = ("2024-12-01 00:00:00", DETECTED_AT)


def q_upsert_importance_stamped(spark, sf):
    """Upsert with created_at / updated_at at fixed times."""
    old = tpch.customer_importance(spark, sf, before=SPLIT_DATE).withColumns(
        {c: F.lit(STAMPS[0]).cast("timestamp") for c in ("created_at", "updated_at")})
    new = tpch.customer_importance(spark, sf, since=SPLIT_DATE)
    out = upsert(old, new, ["Source", "typeTrans"], as_of=STAMPS[1])
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("created_at", "updated_at")})


def q_importance_fallback(spark, sf):
    """A table that lacks a column is replaced by one built from all orders."""
    broken = tpch.table(spark, sf, "orders").select(F.col("o_custkey").alias("Source"))
    return importance_chain(spark, lambda s: broken, fallback=_imp(spark, sf))


def q_insert_if_absent(spark, sf):
    old = tpch.customer_importance(spark, sf, before=SPLIT_DATE)
    new = tpch.customer_importance(spark, sf, since=SPLIT_DATE)
    return insert_if_absent(old, new, ["Source", "typeTrans"], state_col="row_state")


def q_table_counts(spark, sf):
    # transactions, pairs and eligible merchants are all sums over the pair counts
    per_merchant = upgrade.customer_pairs(_tx(spark, sf)).groupBy("merchant").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("transaction_count").alias("rows"))
    counts = per_merchant.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("transactions"),
        F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("customer_pairs"),
        F.count(F.when(F.col("rows") > THRESHOLD, 1)).alias("eligible_merchants"))
    return counts.unpivot([], counts.columns, "table_name", "row_count").unionByName(
        table_counts({"customer_importance": _imp(spark, sf)}))


def q_customer_weights(spark, sf):
    weights = upgrade.customer_weights(_imp(spark, sf)).select(
        F.col("Source").alias("customer"), F.col("__ll_customer_weight").alias("customer_weight"))
    return _rounded(weights, "customer_weight")


def q_unprocessed_orders(spark, sf):
    # listed items (orders) minus the processed set (orders whose lines landed)
    listed = tpch.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    landed = tpch.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return unprocessed(listed, landed, ["o_orderkey"])


def q_csv_valid_reject(spark, sf):
    """Every line as a CSV record, some spoiled: a word as the amount, or a field too few."""
    tx = _tx(spark, sf)
    fields = {"step": "step", "customer": "customer", "merchant": "merchant",
              "amount": "case when l_linenumber = 7 then 'n/a' else string(amount) end"}
    record = [F.coalesce(F.expr(f"string({fields[c]})"), F.lit("")) if c in fields else F.lit("")
              for c in schemas.TRANSACTIONS.fieldNames()[:-1]]
    line = F.concat_ws(",", *record, F.when(F.col("l_linenumber") != 6, F.lit("0")))
    lines = tx.select("l_orderkey", "l_linenumber", "l_partkey", line.alias("value"))
    # integers that can be missing as text, which both engines write alike
    return valid_or_reason(lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("step").cast("string"), "customer", "merchant", "amount",
        F.col("fraud").cast("string"), "reject_reason")


def merchant_state(spark, sf):
    """The stored merchant tables after three batches that together hold every line."""
    state = incremental.MerchantState(spark, scratch_path(spark, "merchant-state"), THRESHOLD, buckets=16,
                                      customer_type="BIGINT", merchant_type="BIGINT")
    tx, imp = _tx(spark, sf), freeze(_imp(spark, sf), "importance")  # read by every batch, more than once
    parts = [F.col("l_linenumber") <= 2, F.col("l_linenumber").between(3, 4),
             F.coalesce(F.col("l_linenumber") > 4, F.lit(True))]
    for version, part in enumerate(parts):
        state.apply(tx.filter(part), imp, version, DETECTED_AT)
    return state


def q_incremental_detections(spark, sf):
    return upgrade.detection_records(merchant_state(spark, sf).detections(), DETECTED_AT)


def q_stored_merchant_tables(spark, sf):
    """D1 and D2 as the stored tables hold them after the last batch."""
    tables = merchant_state(spark, sf).tables
    stats, scores = (tables.read(t).drop("created_at", "updated_at") for t in (incremental.STATS, incremental.SCORES))
    return _rounded(stats.join(scores, ["customer", "merchant"]))


def q_upsert_versioned(spark, sf):
    """The upsert as versions of a stored table: only buckets with an updated key are rewritten."""
    table = VersionedTables(spark, scratch_path(spark, "importance-versions"), {
        "customer_importance": (tpch.customer_importance(spark, sf).schema.simpleString()[7:-1].replace(":", " "),
                                ["Source"])}, buckets=32)
    for part in ({"before": SPLIT_DATE}, {"since": SPLIT_DATE}):
        table.upsert("customer_importance", tpch.customer_importance(spark, sf, **part), ["Source", "typeTrans"])
    return table.read("customer_importance")


def q_quality_report(spark, sf):
    return quality_report(_tx(spark, sf), ROW_KEY)


def q_monthly_detection_stats(spark, sf):
    det = reports.monthly_detections(_tx(spark, sf), _imp(spark, sf), MONTH_THRESHOLD,
                                     detected_at=DETECTED_AT)
    return reports.monthly_detection_stats(det)


QUERIES: dict[str, Query] = {
    "scan_transactions": q_scan_transactions,
    "scan_importance": q_scan_importance,
    "project_rename": q_project_rename,
    "importance_join": q_importance_join,
    "customer_stats": q_customer_stats,
    "importance_scores": q_importance_scores,
    "merchant_counts": q_merchant_counts,
    "eligible_merchants": q_eligible_merchants,
    "top_merchants": q_top_merchants,
    "threshold_advice": q_threshold_advice,
    "eligible_stats": q_eligible_stats,
    "pattern_matches": q_pattern_matches,
    "detections": q_detections,
    "detect_upgrades": q_detect_upgrades,
    "detect_upgrades_per_chunk": q_detect_upgrades_per_chunk,
    "chunk_assignment": q_chunk_assignment,
    "source_chunks": q_source_chunks,
    "detect_upgrades_per_source_chunk": q_detect_upgrades_per_source_chunk,
    "chunk_progress": q_chunk_progress,
    "detection_batches": q_detection_batches,
    "upsert_importance": q_upsert_importance,
    "upsert_importance_stamped": q_upsert_importance_stamped,
    "upsert_versioned": q_upsert_versioned,
    "incremental_detections": q_incremental_detections,
    "stored_merchant_tables": q_stored_merchant_tables,
    "csv_valid_reject": q_csv_valid_reject,
    "importance_fallback": q_importance_fallback,
    "insert_if_absent": q_insert_if_absent,
    "table_counts": q_table_counts,
    "quality_report": q_quality_report,
    "monthly_detection_stats": q_monthly_detection_stats,
    "customer_weights": q_customer_weights,
    "unprocessed_orders": q_unprocessed_orders,
    "detect_upgrades_hot_merchant": q_detect_upgrades_hot_merchant,
    "importance_scores_hot_merchant": q_importance_scores_hot_merchant,
}


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB dialect; tables are pre-registered views)
# --------------------------------------------------------------------------

_TX = f"tx AS ({tpch.TRANSACTIONS_SQL})"
_TXC = """txc AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, l.l_shipdate,
         CAST(date_diff('day', DATE '1992-01-01', CAST(o.o_orderdate AS DATE)) AS INTEGER) AS step,
         o.o_custkey AS customer, l.l_suppkey AS merchant, l.l_extendedprice AS amount,
         o.o_orderdate AS order_date, p.p_type AS category
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey)"""
_IMP = f"imp AS ({tpch.IMPORTANCE_SQL})"
_TX_HOT = (f"tx AS (SELECT * REPLACE (CASE WHEN merchant % 3 = 0 THEN {HOT_MERCHANT} "
           f"ELSE merchant END AS merchant) FROM ({tpch.TRANSACTIONS_SQL}))")
_PAIRS = ("pairs AS (SELECT customer, merchant, COUNT(*) AS transaction_count "
          "FROM tx GROUP BY customer, merchant)")
# the literal score: every transaction meets every importance row of its customer
# (summed as decimals: amounts have two places, so equal means are equal)
_SC = ("sc AS (SELECT tx.customer, tx.merchant, "
       "CAST(SUM(CAST(COALESCE(imp.Weight, 1.0) AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(*) AS avg_weight "
       "FROM tx LEFT JOIN imp ON tx.customer = imp.Source GROUP BY tx.customer, tx.merchant)")
_W = "w AS (SELECT Source, AVG(COALESCE(Weight, 1.0)) AS cw FROM imp GROUP BY Source)"


def _matches_sql(threshold: int, top: float, low: float, tx: str = _TX) -> str:
    return f"""
WITH {tx}, {_IMP}, {_PAIRS}, {_SC},
cs AS (SELECT customer, merchant, transaction_count,
              PERCENT_RANK() OVER (PARTITION BY merchant ORDER BY transaction_count DESC) AS merchant_rank
       FROM pairs),
isc AS (SELECT customer, merchant, avg_weight,
               PERCENT_RANK() OVER (PARTITION BY merchant ORDER BY avg_weight) AS weight_rank
        FROM sc),
elig AS (SELECT merchant FROM tx GROUP BY merchant HAVING COUNT(*) > {threshold}),
m AS (SELECT cs.customer, cs.merchant, cs.transaction_count, isc.avg_weight
      FROM cs JOIN isc ON cs.customer = isc.customer AND cs.merchant = isc.merchant
      WHERE cs.merchant IN (SELECT merchant FROM elig)
        AND cs.merchant_rank <= {top} AND isc.weight_rank <= {low})"""


def _detections_sql(threshold: int, top: float, low: float, tx: str = _TX) -> str:
    return _matches_sql(threshold, top, low, tx) + f"""
SELECT '{DETECTED_AT}' AS YStartTime, '{DETECTED_AT}' AS detectionTime,
       'PatId1' AS patternId, 'UPGRADE' AS ActionType,
       CAST(customer AS VARCHAR) AS customer, CAST(merchant AS VARCHAR) AS merchant
FROM m"""


def _scoped_detections_sql(scoped_tx: str, scope: str, threshold: int | str) -> str:
    return f"""
WITH {_TX}, {_IMP}, {_W}, stx AS ({scoped_tx}),
pairs AS (SELECT {scope}, customer, merchant, COUNT(*) AS transaction_count
          FROM stx GROUP BY {scope}, customer, merchant),
cs AS (SELECT {scope}, customer, merchant, transaction_count,
              PERCENT_RANK() OVER (PARTITION BY {scope}, merchant ORDER BY transaction_count DESC) AS merchant_rank
       FROM pairs),
isc AS (SELECT p.{scope}, p.customer, p.merchant, COALESCE(w.cw, 1.0) AS avg_weight,
               PERCENT_RANK() OVER (PARTITION BY p.{scope}, p.merchant ORDER BY COALESCE(w.cw, 1.0)) AS weight_rank
        FROM pairs p LEFT JOIN w ON p.customer = w.Source),
elig AS (SELECT {scope}, merchant FROM stx GROUP BY {scope}, merchant HAVING COUNT(*) > {threshold})
SELECT '{DETECTED_AT}' AS YStartTime, '{DETECTED_AT}' AS detectionTime,
       'PatId1' AS patternId, 'UPGRADE' AS ActionType,
       CAST(cs.customer AS VARCHAR) AS customer, CAST(cs.merchant AS VARCHAR) AS merchant,
       cs.{scope}
FROM cs JOIN isc ON cs.{scope} = isc.{scope} AND cs.customer = isc.customer AND cs.merchant = isc.merchant
WHERE (cs.{scope}, cs.merchant) IN (SELECT {scope}, merchant FROM elig)
  AND cs.merchant_rank <= 0.1 AND isc.weight_rank <= 0.1"""


_ORDER = ", ".join(ROW_KEY)
_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_ROW_ID = ", ".join(_TEXT.format(c) if c == "l_shipdate" else c for c in ROW_KEY)
# DuckDB numbers the rows of an unordered window as the file holds them
_SOURCE = ("(SELECT *, ROW_NUMBER() OVER () - 1 AS row_pos FROM lineitem)")
_POS = f"pos AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {_ORDER}) - 1 AS row_pos FROM tx)"


def _upsert_sql(insert_only: bool) -> str:
    old = tpch.importance_sql(f"o_orderdate < TIMESTAMP '{SPLIT_DATE}'")
    new = tpch.importance_sql(f"o_orderdate >= TIMESTAMP '{SPLIT_DATE}'")
    if insert_only:
        return f"""
WITH t AS ({old}), u AS ({new})
SELECT t.*, 'kept' AS row_state FROM t
UNION ALL
SELECT u.*, 'inserted' AS row_state FROM u
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.Source = u.Source AND t.typeTrans = u.typeTrans)"""
    return f"""
WITH t AS ({old}), u AS ({new})
SELECT t.*, 'kept' AS row_state FROM t
WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.Source = t.Source AND u.typeTrans = t.typeTrans)
UNION ALL
SELECT u.*, CASE WHEN EXISTS (SELECT 1 FROM t WHERE t.Source = u.Source AND t.typeTrans = u.typeTrans)
                 THEN 'updated' ELSE 'inserted' END AS row_state
FROM u"""


ORACLE_SQL: dict[str, str] = {
    "scan_transactions": f"""WITH {_TXC}
SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
                  strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date) FROM txc""",
    "scan_importance": tpch.IMPORTANCE_SQL,
    "project_rename": (f"WITH {_TXC} SELECT customer, merchant, category AS transaction_type "
                       "FROM txc"),
    "importance_join": f"""
WITH {_TXC}, {_IMP}
SELECT t.customer, t.merchant, t.category AS transaction_type, COALESCE(i.Weight, 1.0) AS weight
FROM txc t LEFT JOIN imp i ON t.customer = i.Source""",
    "customer_stats": f"""
WITH {_TX}, {_PAIRS}
SELECT customer, merchant, transaction_count,
       PERCENT_RANK() OVER (PARTITION BY merchant ORDER BY transaction_count DESC) AS merchant_rank
FROM pairs""",
    "importance_scores": f"""
WITH {_TX}, {_IMP}, {_SC}
SELECT customer, merchant, ROUND(avg_weight, 6) AS avg_weight,
       PERCENT_RANK() OVER (PARTITION BY merchant ORDER BY avg_weight) AS weight_rank
FROM sc""",
    "merchant_counts": (f"WITH {_TX} SELECT merchant, COUNT(*) AS total_transactions "
                        "FROM tx GROUP BY merchant"),
    "eligible_merchants": (f"WITH {_TX} SELECT merchant, COUNT(*) AS total_transactions "
                           f"FROM tx GROUP BY merchant HAVING COUNT(*) > {THRESHOLD}"),
    "top_merchants": (f"WITH {_TX} SELECT merchant, COUNT(*) AS total_transactions FROM tx "
                      "GROUP BY merchant ORDER BY total_transactions DESC, merchant ASC LIMIT 5"),
    "threshold_advice": f"""
WITH {_TX}, mt AS (SELECT merchant, COUNT(*) AS total_transactions FROM tx GROUP BY merchant)
SELECT COUNT(*) AS total_merchants,
       COUNT(CASE WHEN total_transactions > {upgrade.DEFAULT_THRESHOLD} THEN 1 END) AS eligible_merchants,
       CAST(COALESCE(MAX(total_transactions), 0) AS BIGINT) AS max_transactions,
       CAST({upgrade.DEFAULT_THRESHOLD} AS BIGINT) AS threshold
FROM mt""",
    "eligible_stats": f"""
WITH {_TX}, {_PAIRS},
cs AS (SELECT customer, merchant, transaction_count,
              PERCENT_RANK() OVER (PARTITION BY merchant ORDER BY transaction_count DESC) AS merchant_rank
       FROM pairs)
SELECT * FROM cs
WHERE merchant IN (SELECT merchant FROM tx GROUP BY merchant HAVING COUNT(*) > {THRESHOLD})""",
    "pattern_matches": _matches_sql(THRESHOLD, 0.1, 0.1)
    + " SELECT * REPLACE (ROUND(avg_weight, 6) AS avg_weight) FROM m",
    "detections": _detections_sql(THRESHOLD, 0.1, 0.1),
    "detect_upgrades": _detections_sql(550, 0.2, 0.2),
    "detect_upgrades_per_chunk": _scoped_detections_sql(
        f"SELECT *, (ROW_NUMBER() OVER (ORDER BY {_ORDER}) - 1) // {CHUNK_SIZE} "
        "AS chunk_id FROM tx", "chunk_id", f"(SELECT {CHUNK_SIZE} // GREATEST(COUNT(*), 1) FROM supplier)"),
    "source_chunks": f"""
SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate),
       row_pos // {CHUNK_SIZE} AS chunk_id FROM {_SOURCE}""",
    "detect_upgrades_per_source_chunk": _scoped_detections_sql(
        f"SELECT o.o_custkey AS customer, l.l_suppkey AS merchant, l.row_pos // {CHUNK_SIZE} AS chunk_id "
        f"FROM {_SOURCE} l JOIN orders o ON l.l_orderkey = o.o_orderkey", "chunk_id",
        f"(SELECT {CHUNK_SIZE} // GREATEST(COUNT(*), 1) FROM supplier)"),
    "chunk_assignment": f"""
WITH {_TX}, {_POS}
SELECT {_ROW_ID}, row_pos, row_pos // {CHUNK_SIZE} AS chunk_id FROM pos""",
    "chunk_progress": f"""
WITH {_TX}, {_POS},
c AS (SELECT row_pos // {CHUNK_SIZE} AS chunk_id, COUNT(*) AS size, MIN(row_pos) AS start,
             MAX(row_pos) + 1 AS "end" FROM pos GROUP BY 1)
SELECT chunk_id + 1 AS chunk_number,
       ((SELECT COUNT(*) FROM tx) + {CHUNK_SIZE} - 1) // {CHUNK_SIZE} AS total_chunks,
       start, "end", size,
       ROUND(CAST("end" AS DOUBLE) / (SELECT COUNT(*) FROM tx) * 100.0, 1) AS progress_pct
FROM c""",
    "detection_batches": _detections_sql(THRESHOLD, 0.1, 0.1).replace(
        "\nSELECT '", "\n, d AS (SELECT '", 1) + f""")
SELECT *, ROW_NUMBER() OVER (ORDER BY merchant, customer) - 1 AS batch_pos,
       (ROW_NUMBER() OVER (ORDER BY merchant, customer) - 1) // {BATCH_SIZE} AS batch_id
FROM d""",
    "upsert_importance": _upsert_sql(False),
    "upsert_importance_stamped": f"""
WITH x AS ({_upsert_sql(False)})
SELECT * EXCLUDE (row_state),
       CASE row_state WHEN 'inserted' THEN '{STAMPS[1]}' ELSE '{STAMPS[0]}' END AS created_at,
       CASE row_state WHEN 'kept' THEN '{STAMPS[0]}' ELSE '{STAMPS[1]}' END AS updated_at
FROM x""",
    "upsert_versioned": f"WITH x AS ({_upsert_sql(False)}) SELECT * EXCLUDE (row_state) FROM x",
    "incremental_detections": _detections_sql(THRESHOLD, 0.1, 0.1),
    "stored_merchant_tables": f"""
WITH {_TX}, {_IMP}, {_PAIRS}, {_SC}
SELECT p.customer, p.merchant, transaction_count,
       PERCENT_RANK() OVER (PARTITION BY p.merchant ORDER BY transaction_count DESC) AS merchant_rank,
       ROUND(avg_weight, 6) AS avg_weight,
       PERCENT_RANK() OVER (PARTITION BY p.merchant ORDER BY avg_weight) AS weight_rank
FROM pairs p JOIN sc ON p.customer = sc.customer AND p.merchant = sc.merchant""",
    "csv_valid_reject": f"""
WITH {_TX}
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN ok THEN CAST(step AS VARCHAR) END AS step, CASE WHEN ok THEN CAST(customer AS VARCHAR) END AS customer,
       CASE WHEN ok THEN CAST(merchant AS VARCHAR) END AS merchant, CASE WHEN ok THEN amount END AS amount,
       CASE WHEN ok THEN '0' END AS fraud, CASE WHEN NOT ok THEN 'malformed' END AS reject_reason
FROM (SELECT *, l_linenumber NOT IN (6, 7) AS ok FROM tx)""",
    "importance_fallback": tpch.IMPORTANCE_SQL,
    "insert_if_absent": _upsert_sql(True),
    "table_counts": f"""
WITH {_TX}, {_IMP}, {_PAIRS}
SELECT 'transactions' AS table_name, COUNT(*) AS row_count FROM tx
UNION ALL SELECT 'customer_importance', COUNT(*) FROM imp
UNION ALL SELECT 'customer_pairs', COUNT(*) FROM pairs
UNION ALL SELECT 'eligible_merchants', COUNT(*) FROM
  (SELECT merchant FROM tx GROUP BY merchant HAVING COUNT(*) > {THRESHOLD})""",
    "quality_report": f"""
WITH {_TX}
SELECT COUNT(*) AS total_rows,
  COUNT(CASE WHEN NOT (customer IS NULL OR merchant IS NULL OR amount IS NULL OR amount < 0
                       OR step < 0) THEN 1 END) AS valid_rows,
  COUNT(CASE WHEN customer IS NULL OR merchant IS NULL OR amount IS NULL OR amount < 0
                  OR step < 0 THEN 1 END) AS rejected_rows,
  COUNT(CASE WHEN customer IS NULL THEN 1 END) AS null_customer,
  COUNT(CASE WHEN merchant IS NULL THEN 1 END) AS null_merchant,
  COUNT(CASE WHEN amount IS NULL THEN 1 END) AS null_amount,
  COUNT(CASE WHEN amount < 0 THEN 1 END) AS negative_amount,
  MIN(amount) AS min_amount, MAX(amount) AS max_amount,
  MIN(step) AS min_step, MAX(step) AS max_step,
  (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM
     (SELECT COUNT(*) AS n FROM tx GROUP BY {_ORDER} HAVING COUNT(*) > 1) d)
    AS duplicate_keys
FROM tx""",
    "monthly_detection_stats": f"""
WITH det AS ({_scoped_detections_sql(
        "SELECT *, strftime(order_date, '%Y-%m') AS month FROM tx", "month", MONTH_THRESHOLD)})
SELECT month, patternId, merchant, COUNT(*) AS detections, COUNT(DISTINCT customer) AS customers
FROM det GROUP BY month, patternId, merchant""",
    "customer_weights": f"""
WITH {_IMP}
SELECT Source AS customer, ROUND(AVG(COALESCE(Weight, 1.0)), 6) AS customer_weight
FROM imp GROUP BY Source""",
    "unprocessed_orders": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "detect_upgrades_hot_merchant": _detections_sql(THRESHOLD, 0.1, 0.1, _TX_HOT),
    "importance_scores_hot_merchant": f"""
WITH {_TX_HOT}, {_IMP}, {_SC}
SELECT customer, merchant, ROUND(avg_weight, 6) AS avg_weight,
       PERCENT_RANK() OVER (PARTITION BY merchant ORDER BY avg_weight) AS weight_rank
FROM sc""",
}
