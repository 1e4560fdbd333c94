"""Key-based table maintenance without a MERGE-capable table format.

Both operators produce the *new version* of a table as a DataFrame; callers
write it to a new location / table and switch over, never overwriting the
path they are reading.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], as_of=None,
           created_col: str | None = "created_at", updated_col: str | None = "updated_at",
           state_col: str | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET <all other columns>``.

    Rows of ``updates`` replace target rows with the same key, new keys are
    added, other target rows stay.  Two updates of one key are an error, as in
    a database (found in the same job, by the aggregate that groups them).
    With timestamp columns, ``created_col`` keeps the target's value for
    replaced rows and ``updated_col`` becomes ``as_of`` (default: the query's
    current timestamp) for every written row.  ``state_col`` (optional) tells
    ``kept`` / ``updated`` / ``inserted`` apart.

    One full outer join on the key: each side is shuffled once.
    """
    keys = list(keys)
    now = _as_of(as_of)
    stamps = {c for c in (created_col, updated_col) if c}
    business = [c for c in updates.columns if c not in stamps]
    values = [c for c in business if c not in keys]
    tcols = set(target.columns)

    t = target.select(*keys, *[F.col(c).alias(f"__ll_t_{c}") for c in target.columns
                               if c not in keys], F.lit(True).alias("__ll_t"))
    same = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL")))
                               for k in keys])
    u = (updates.groupBy(*keys).agg(F.first(F.struct(F.lit(True).alias("__ll_u"), *values)).alias("__ll_row"),
                                    F.count(F.lit(1)).alias("__ll_n"))
         .select(*keys, *[F.col(f"__ll_row.{c}").alias(f"__ll_u_{c}") for c in values],
                 F.when(F.col("__ll_n") > 1, F.raise_error(F.concat(F.lit("several updates of "), same)))
                 .otherwise(F.lit(True)).cast("boolean").alias("__ll_u")))
    j = t.join(u, keys, "full_outer")
    from_update = F.col("__ll_u").isNotNull()

    def pick(c):
        old = F.col(f"__ll_t_{c}") if c in tcols else F.lit(None)
        return F.when(from_update, F.col(f"__ll_u_{c}")).otherwise(old).alias(c)

    out = [F.col(k) for k in keys] + [pick(c) for c in values]
    # target columns the updates do not carry stay as they are
    out += [F.col(f"__ll_t_{c}").alias(c) for c in target.columns
            if c not in keys and c not in values and c not in stamps]
    if created_col:
        prior = F.col(f"__ll_t_{created_col}") if created_col in tcols else F.lit(None).cast("timestamp")
        out.append(F.when(from_update, F.coalesce(prior, now)).otherwise(prior).alias(created_col))
    if updated_col:
        prior = F.col(f"__ll_t_{updated_col}") if updated_col in tcols else F.lit(None).cast("timestamp")
        out.append(F.when(from_update, now).otherwise(prior).alias(updated_col))
    if state_col:
        out.append(F.when(~from_update, F.lit("kept"))
                   .when(F.col("__ll_t").isNotNull(), F.lit("updated"))
                   .otherwise(F.lit("inserted")).alias(state_col))
    return j.select(*out)


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                     state_col: str | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``.

    Keys already in ``target`` are skipped; among new rows sharing a key the
    first in the order of ``order_by`` (then of all columns) is inserted.
    """
    keys = list(keys)
    first = [*(order_by or []), *[c for c in rows.columns if c not in (order_by or [])]]
    fresh = (rows.join(target.select(*keys), keys, "left_anti")
             .groupBy(*[F.col(k).alias(f"__ll_k_{k}") for k in keys])
             .agg(F.min(F.struct(*first)).alias("__ll_row"))
             .select(*[F.col(f"__ll_row.{c}").alias(c) for c in rows.columns]))
    if state_col:
        target = target.withColumn(state_col, F.lit("kept"))
        fresh = fresh.withColumn(state_col, F.lit("inserted"))
    return target.unionByName(fresh, allowMissingColumns=True)


def unprocessed(listed: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Listed items that are not yet in the processed set (anti-join)."""
    return listed.join(processed.select(*keys), list(keys), "left_anti")
