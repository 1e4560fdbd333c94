"""Transactions and customer importance derived from the star-schema test tables.

Mapping (one transaction per order line):

* customer  = ``orders.o_custkey``
* merchant  = ``lineitem.l_suppkey``
* category  = ``part.p_type`` (only joined when asked for)
* amount    = ``lineitem.l_extendedprice``
* step      = days from 1992-01-01 to ``o_orderdate`` (integer time index)

Importance: all orders per (customer, priority), weight = the largest order
total of a high priority, NULL for the others.  Unique on (Source, typeTrans)
like the real dimension; NULL weights and customers without orders exercise
the default weight.

Keys stay the tables' native ``bigint`` through the whole plan (cheaper to
hash and sort than text); detection records render them as strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift import schemas

# Fixed values of the mapping.
HIGH_PRIORITIES = ("1-URGENT", "2-HIGH")
STEP_EPOCH = "1992-01-01"

# lineitem columns passed through besides merchant (l_suppkey) and amount
# (l_extendedprice).  (l_orderkey, l_linenumber) repeats in the test tables;
# only the whole line is unique, so the global row order uses all of it.
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
                "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "merchant", "l_quantity", "amount",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the star-schema tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, with_category: bool = False,
                 lines: DataFrame | None = None, keep=()) -> DataFrame:
    """Order lines as transactions.

    ``lines`` stands in for the lineitem table and ``keep`` names more of its columns.

    Columns: the remaining lineitem columns (together with merchant and amount
    they identify a row; see ``ROW_KEY``), step, customer, merchant, amount,
    order_date[, category].  Unused columns are pruned from the scans
    by Catalyst; the ``part`` join is only planned when ``with_category``.
    """
    li = lines if lines is not None else table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    tx = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
    cols = [li[c] for c in [*LINE_COLUMNS, *keep]] + [
        F.datediff(orders["o_orderdate"], F.lit(STEP_EPOCH).cast("date")).alias("step"),
        orders["o_custkey"].alias("customer"),
        li["l_suppkey"].alias("merchant"),
        li["l_extendedprice"].alias("amount"),
        orders["o_orderdate"].alias("order_date"),
    ]
    if with_category:
        part = table(spark, sf_dir, "part")
        tx = tx.join(part, li["l_partkey"] == part["p_partkey"], "inner")
        cols.append(part["p_type"].alias("category"))
    return tx.select(*cols)


def as_transaction_records(tx: DataFrame, keep=()) -> DataFrame:
    """The mapped transactions in the landing-file layout (``schemas.TRANSACTIONS``).

    Ids become text; fields without a counterpart in the star schema are NULL.
    ``keep`` names extra columns to carry along (e.g. the row key).
    """
    present = set(tx.columns)
    cols = []
    for field in schemas.TRANSACTIONS.fields:
        if field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return tx.select(*cols, *[F.col(c) for c in keep])


def customer_importance(spark: SparkSession, sf_dir: str, before: str | None = None,
                        since: str | None = None) -> DataFrame:
    """Importance dimension: Source, Target, Weight, typeTrans, fraud.

    Every customer and priority of all orders; the low priorities carry a NULL
    weight (which counts as the default).

    ``before`` / ``since`` (``yyyy-MM-dd``) restrict the orders used, which
    yields two versions of the dimension for upsert tests.
    """
    orders = table(spark, sf_dir, "orders")
    if before is not None:
        orders = orders.filter(F.col("o_orderdate") < F.lit(before).cast("timestamp"))
    if since is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp"))
    return (orders
            .groupBy("o_custkey", "o_orderpriority")
            .agg(F.max(F.when(F.col("o_orderpriority").isin(*HIGH_PRIORITIES), F.col("o_totalprice")))
                 .alias("Weight"))
            .select(F.col("o_custkey").alias("Source"),
                    F.lit(None).cast("string").alias("Target"),
                    F.col("Weight"),
                    F.col("o_orderpriority").alias("typeTrans"),
                    F.lit(0).alias("fraud")))


# SQL text of the same mapping, for DuckDB oracles.
TRANSACTIONS_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_discount, l.l_tax,
       l.l_returnflag, l.l_linestatus, l.l_shipdate,
       CAST(date_diff('day', DATE '1992-01-01', CAST(o.o_orderdate AS DATE)) AS INTEGER) AS step,
       o.o_custkey AS customer, l.l_suppkey AS merchant, l.l_extendedprice AS amount,
       o.o_orderdate AS order_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

def importance_sql(extra_where: str = "") -> str:
    cond = f" WHERE {extra_where}" if extra_where else ""
    return f"""
SELECT o_custkey AS Source, CAST(NULL AS VARCHAR) AS Target,
       MAX(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END) AS Weight,
       o_orderpriority AS typeTrans, 0 AS fraud
FROM orders{cond}
GROUP BY o_custkey, o_orderpriority
"""


IMPORTANCE_SQL = importance_sql()
