"""Importance dimension: validation, explicit fallback, seeding, empty guards."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerlift import schemas
from ledgerlift.operators.merge import insert_if_absent


def has_columns(df: DataFrame, required: Sequence[str] = schemas.IMPORTANCE_REQUIRED) -> bool:
    present = set(df.columns)
    return all(c in present for c in required)


def validated_importance(df: DataFrame | None, fallback: DataFrame | None = None) -> DataFrame:
    """``df`` when it carries every importance column, else ``fallback``.

    Extra columns are accepted.  Without a fallback a wrong schema is an error
    (a silent 5-row stand-in would make every weight meaningless).
    """
    if df is not None and has_columns(df):
        return df
    if fallback is None:
        missing = [] if df is None else [c for c in schemas.IMPORTANCE_REQUIRED
                                         if c not in set(df.columns)]
        raise ValueError(f"importance table unusable; missing columns {missing}")
    if not has_columns(fallback):
        raise ValueError("fallback importance frame lacks required columns")
    return fallback


def importance_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A caller-supplied importance frame with the declared schema."""
    return spark.createDataFrame(rows, schemas.IMPORTANCE)


def empty_detections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.DETECTIONS)


def is_empty(df: DataFrame) -> bool:
    """Cheap emptiness test (reads at most one row)."""
    return df.isEmpty()


def seed_if_empty(current: DataFrame, seed: DataFrame,
                  keys: Sequence[str] = schemas.IMPORTANCE_KEY) -> DataFrame:
    """``current`` if it has a row, else the seed rows (one per key)."""
    return insert_if_absent(current, seed, keys) if is_empty(current) else current


def importance_chain(spark: SparkSession, load, seed: DataFrame | None = None,
                     fallback: DataFrame | None = None) -> DataFrame:
    """The importance table as a job should use it: read, seed if empty, check columns, fall back.

    ``load(spark)`` gives the table or None.  Rows of ``seed`` stand in for an
    empty table, ``fallback`` for a missing one or one that lacks a column;
    without them these cases are errors.
    """
    table = load(spark)
    if table is not None and has_columns(table):
        if seed is not None:
            return seed_if_empty(table, seed)
        if is_empty(table) and fallback is not None:
            return validated_importance(None, fallback)
    return validated_importance(table, fallback)
