"""Exact ``percent_rank`` per group without one task per group.

``percent_rank() OVER (PARTITION BY g ORDER BY v)`` is, for a row with value
``v`` in a group of ``N`` rows, ``less(v) / (N - 1)`` (0.0 when ``N == 1``),
where ``less(v)`` counts the group's rows that sort strictly before ``v``.
Spark's Window operator evaluates a whole group inside one task, so a merchant
holding a third of all rows would become one giant sort.  One route serves
groups of every size:

1. *slices* -- rows (or the distinct values of a cut, with their counts) are
   range-partitioned on ``(g, v)`` and, for rows, a hash of the row, so neither
   a hot group nor a hot value stays in one partition.  The partition index is
   the slice id; the sliced table is materialized once
   (:func:`ledgerlift.session.freeze`) so that every later reader sees the
   same ids.
2. *local rank* -- a window per ``(g, slice)``; its size is bounded by one
   slice, never by the group.
3. *offsets* -- one row per ``(g, slice)`` (at most groups + slices rows): the
   rows of earlier slices, ``N``, and where the slice's first value begins if
   an earlier slice holds the same value.
4. the offsets are joined back on ``(g, slice)``, at most one slice's rows a key.

For a count column ``rank_cut(method="histogram")`` is enough: a group with R
rows has at most sqrt(2R) distinct counts, so the window over its tie
histogram is always small.  ``method="window"`` keeps Spark's plain Window
for every group, for comparison.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.session import freeze

_N = "__ll_n"
_SLICE = "__ll_slice"
_LT_LOCAL = "__ll_lt_local"
_LT_BEFORE = "__ll_lt_before"
_GROUP_N = "__ll_group_n"
_SLICE_N = "__ll_slice_n"

_FIRST = "__ll_first"
_LAST = "__ll_last"
_START = "__ll_start"


def _as_list(cols: str | Iterable[str] | None) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _order(col: str, ascending: bool) -> Column:
    # Spark's window defaults: ASC NULLS FIRST, DESC NULLS LAST.
    return F.col(col).asc() if ascending else F.col(col).desc()


def _window(by: Sequence[str]):
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``).

    Spark plans ``<=>`` as an ordinary hashable equi-join key, so this is a
    normal shuffle / broadcast join, not a nested loop.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("join_null_safe needs at least one key")
    alias = {k: f"__ll_r_{k}" for k in keys}
    right = right.select(*[F.col(c).alias(alias[c]) if c in alias else F.col(c)
                           for c in right.columns])
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[alias[k]]) for k in keys])
    return left.join(right, cond, how).drop(*alias.values())


def _pct(less: Column, total: Column) -> Column:
    # Spark's PercentRank: (rank - 1) / (n - 1), 0.0 for a single row.
    return (F.when(total > 1, less.cast("double") / (total - 1).cast("double"))
            .otherwise(F.lit(0.0)))


def _ranks_by_window(hist: DataFrame, by: list[str], order_col: str, ascending: bool,
                     out_col: str) -> DataFrame:
    """Window over the tie histogram: one task per group, sized by the group's
    number of *distinct* values, not its rows."""
    order = _order(order_col, ascending)
    before = _window(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    less = F.coalesce(F.sum(_N).over(before), F.lit(0))
    total = F.sum(_N).over(_window(by))
    return hist.select(*by, order_col, _N, _pct(less, total).alias(out_col))


def _by_range(df: DataFrame, slices: int | None, *keys: Column) -> DataFrame:
    return df.repartitionByRange(slices, *keys) if slices else df.repartitionByRange(*keys)


def _ranks_by_slices(hist: DataFrame, by: list[str], order_col: str, ascending: bool,
                     out_col: str, slices: int | None = None) -> DataFrame:
    """Range slices of the histogram (module docstring)."""
    order = _order(order_col, ascending)
    # Slice ids depend on sampled range bounds: materialize them once so the
    # two consumers below (local prefix, per-slice totals) agree.
    sliced = freeze(_by_range(hist, slices, *[F.col(c) for c in by], order)
                    .withColumn(_SLICE, F.spark_partition_id()), "rank-slices")
    before_in_slice = (Window.partitionBy(*by, _SLICE).orderBy(order)
                       .rowsBetween(Window.unboundedPreceding, -1))
    local = sliced.withColumn(
        _LT_LOCAL, F.coalesce(F.sum(_N).over(before_in_slice), F.lit(0)))

    per_slice = local.groupBy(*by, _SLICE).agg(F.sum(_N).alias(_SLICE_N))
    slices_before = (_window(by).orderBy(_SLICE)
                     .rowsBetween(Window.unboundedPreceding, -1))
    per_slice = (per_slice
                 .withColumn(_LT_BEFORE,
                             F.coalesce(F.sum(_SLICE_N).over(slices_before), F.lit(0)))
                 .withColumn(_GROUP_N, F.sum(_SLICE_N).over(_window(by)))
                 .drop(_SLICE_N))

    keyed = join_null_safe(local, per_slice, [*by, _SLICE])
    less = F.col(_LT_BEFORE) + F.col(_LT_LOCAL)
    return keyed.select(*by, order_col, _N, _pct(less, F.col(_GROUP_N)).alias(out_col))


def _rank_rows(df: DataFrame, by: list[str], order_col: str, ascending: bool, out_col: str,
               slices: int | None) -> DataFrame:
    """Range slices of the rows themselves (module docstring).

    The range key ends in a hash of the row: rows of one (group, value) spread
    over slices like any others, and no join ever meets on a value."""
    order = _order(order_col, ascending)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sliced = freeze(_by_range(df, slices, *[F.col(c) for c in by], order, spread)
                    .withColumn(_SLICE, F.spark_partition_id()), "rank-rows")
    in_slice = Window.partitionBy(*by, _SLICE).orderBy(order)
    local = sliced.withColumn(_LT_LOCAL, (F.rank().over(in_slice) - 1).cast("long"))

    value = F.struct(F.col(order_col).alias("v"))  # a struct: a NULL value is a value
    per_slice = local.groupBy(*by, _SLICE).agg(
        F.count(F.lit(1)).alias(_SLICE_N),
        F.min(F.when(F.col(_LT_LOCAL) == 0, value)).alias(_FIRST),
        F.max_by(value, F.col(_LT_LOCAL)).alias(_LAST),
        F.max(_LT_LOCAL).alias(_LT_BEFORE))
    slices_before = (_window(by).orderBy(_SLICE)
                     .rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(F.sum(_SLICE_N).over(slices_before), F.lit(0))
    per_slice = per_slice.select(
        *by, _SLICE, _FIRST, _LAST, offset.alias(_N), (offset + F.col(_LT_BEFORE)).alias(_LT_BEFORE),
        F.sum(_SLICE_N).over(_window(by)).alias(_GROUP_N))
    # Only a slice's first and last values can go on in other slices; a value
    # begins where its first slice has it.
    begins = (per_slice.select(*by, F.col(_FIRST), F.col(_N).alias(_START))
              .union(per_slice.select(*by, F.col(_LAST), F.col(_LT_BEFORE)))
              .groupBy(*by, _FIRST).agg(F.min(_START).alias(_START)))
    offsets = join_null_safe(per_slice.drop(_LAST, _LT_BEFORE), begins, [*by, _FIRST]).drop(_FIRST)
    keyed = join_null_safe(local, offsets, [*by, _SLICE])
    less = F.when(F.col(_LT_LOCAL) == 0, F.col(_START)).otherwise(F.col(_N) + F.col(_LT_LOCAL))
    return keyed.select(*[F.col(f"`{c}`") for c in df.columns],
                        _pct(less, F.col(_GROUP_N)).alias(out_col))


def ranked_values(df: DataFrame, by: str | Iterable[str] | None, order_col: str,
                  ascending: bool = True, out_col: str = "pct_rank", method: str = "auto",
                  slices: int | None = None) -> DataFrame:
    """One row per distinct ``(by, order_col)`` with its exact percent rank.

    Columns: ``by..., order_col, __ll_n (input rows with that key), out_col``.

    ``method``:
      * ``"histogram"`` -- window over the tie histogram.  Safe whenever the
        number of distinct values per group is bounded; for a *count* column
        it always is: a group with R rows has at most sqrt(2R) distinct counts.
      * ``"sliced"`` / ``"auto"`` -- range slices, safe for any distribution.
    ``slices``: number of range partitions (default: the session's).
    """
    by = _as_list(by)
    hist = df.groupBy(*by, order_col).agg(F.count(F.lit(1)).alias(_N))
    if method == "histogram":
        return _ranks_by_window(hist, by, order_col, ascending, out_col)
    if method not in ("sliced", "auto"):
        raise ValueError(f"unknown method {method!r}")
    return _ranks_by_slices(hist, by, order_col, ascending, out_col, slices)


def percent_rank_within(df: DataFrame, by: str | Iterable[str] | None, order_col: str,
                        ascending: bool = True, out_col: str = "pct_rank",
                        method: str = "auto", slices: int | None = None) -> DataFrame:
    """``df`` plus ``percent_rank() OVER (PARTITION BY by ORDER BY order_col)``.

    * ``"auto"`` / ``"sliced"`` -- range slices of the rows, for groups of every size.
    * ``"histogram"`` -- rank the distinct values (:func:`ranked_values`) and
      join back on ``(by, order_col)``.
    * ``"window"`` -- Spark's Window for every group (unbounded per task).
    """
    by = _as_list(by)
    if out_col in df.columns:
        df = df.drop(out_col)
    if method == "window":
        return _window_rank(df, by, order_col, ascending, out_col)
    if method == "histogram":
        ranks = ranked_values(df, by, order_col, ascending, out_col, method).drop(_N)
        return join_null_safe(df, ranks, [*by, order_col])
    if method not in ("auto", "sliced"):
        raise ValueError(f"unknown method {method!r}")
    return _rank_rows(df, by, order_col, ascending, out_col, slices)


def _window_rank(df: DataFrame, by: list[str], order_col: str, ascending: bool,
                 out_col: str) -> DataFrame:
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(
        _order(order_col, ascending))
    return df.withColumn(out_col, F.percent_rank().over(w))


def percent_ranks_by_window(df: DataFrame, by: str | Iterable[str],
                            orders: Sequence[tuple[str, bool, str]]) -> DataFrame:
    """``df`` plus a percent rank per ``(order_col, ascending, out_col)``, by Spark's Window.

    All ranks share one shuffle on ``by`` (none, if ``df`` is already clustered by these
    columns).  A group is one task's, so its size must be bounded by the caller."""
    for order_col, ascending, out_col in orders:
        df = _window_rank(df, _as_list(by), order_col, ascending, out_col)
    return df


def rank_cut(df: DataFrame, by: str | Iterable[str] | None, order_col: str,
             ascending: bool, max_pct: float, cut_col: str = "cut_value",
             method: str = "auto", slices: int | None = None) -> DataFrame:
    """Per group, the last value (in rank order) whose percent rank is <= ``max_pct``.

    percent_rank never decreases along the order, so the rows that pass
    ``pct <= max_pct`` are exactly those with ``order_col`` on the near side of
    this value (``>=`` it when descending, ``<=`` when ascending).  One row per
    group: a filter against it replaces a per-row join of the rank.  Rows
    whose value is NULL are not covered by the cut value; ``order_col`` is
    expected to be non-null (it is for counts and coalesced weights).
    """
    by = _as_list(by)
    src = df.select(*by, order_col)
    ranked = _window_rank(src, by, order_col, ascending, "__ll_pct") if method == "window" else \
        ranked_values(src, by, order_col, ascending, "__ll_pct", method, slices)
    passing = ranked.filter(F.col("__ll_pct") <= F.lit(max_pct))
    pick = F.min if not ascending else F.max
    return passing.groupBy(*by).agg(pick(order_col).alias(cut_col))


def passes_cut(value: Column, cut: Column, ascending: bool) -> Column:
    return value <= cut if ascending else value >= cut
