"""CSV files read line by line, so that a bad file or a bad line stops nothing.

A file joins only if its header names the schema's columns in order; else all
its lines are set aside.  A line that doesn't parse (wrong number of fields, a
value that isn't of its type) is set aside alone.  What is set aside keeps
file, line number, reason and the raw line, so it can be mended and landed
again.

Lines are one record each: quoted line breaks inside a field aren't supported
(such a record is two rejected lines).  Blank lines are skipped but counted in
line numbers.  A file without any line gives no rows and no rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift import schemas
from ledgerlift.operators.source_order import FILE, FIRST, LINE_BEFORE, PLACE, split_offsets, tag_source, with_split_offsets

SOURCE_FILE = "source_file"
LINE = "line_number"
REASON = "reject_reason"
RAW = "raw_line"
BAD_HEADER, BAD_LINE = "header", "malformed"
REJECT_COLUMNS = [SOURCE_FILE, LINE, REASON, RAW]
_CORRUPT = "__ll_corrupt"
_RECORD = "__ll_record"


def parse_lines(value: Column, schema: T.StructType, strip_quotes: bool = False) -> Column:
    """A line as a struct of the schema's fields and ``__ll_corrupt``: the line, if it doesn't parse."""
    known = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    if strip_quotes:
        options["quote"] = "'"
    return F.from_csv(value, known.simpleString()[len("struct<"):-1].replace(":", " "), options)


def valid_or_reason(df: DataFrame, schema: T.StructType = schemas.TRANSACTIONS, value_col: str = "value",
                    strip_quotes: bool = False) -> DataFrame:
    """``df`` with its lines parsed: the schema's columns (NULL for a rejected line) and the reason."""
    other = [F.col(f"`{c}`") for c in df.columns]
    parsed = df.withColumn(_RECORD, parse_lines(F.col(value_col), schema, strip_quotes))
    bad = F.col(f"{_RECORD}.{_CORRUPT}").isNotNull()
    return parsed.select(*other, *[F.when(~bad, F.col(f"{_RECORD}.`{c}`")).alias(c) for c in schema.fieldNames()],
                         F.when(bad, F.lit(BAD_LINE)).alias(REASON))


def _header_names(value: Column) -> Column:
    """A header line as it is compared: no byte order mark, quotes or spaces, any case."""
    return F.lower(F.regexp_replace(value, "[﻿\"'\\s]", ""))


def checked_lines(lines: DataFrame, schema: T.StructType = schemas.TRANSACTIONS,
                  strip_quotes: bool = False) -> DataFrame:
    """Tagged lines (``value`` and the tags of ``tag_source``) as records with file, line and reason.

    A file's header is looked up by (file, line 1), one row per file; lines are never sorted."""
    located = with_split_offsets(lines, split_offsets(lines))
    located = located.withColumn(LINE, (F.col(PLACE) - F.col(FIRST) + F.col(LINE_BEFORE) + 1).cast("long"))
    fits = _header_names(F.col("value")) == ",".join(schema.fieldNames()).lower()
    headers = located.filter(F.col(LINE) == 1).select(FILE, fits.alias("__ll_fits"))
    body = located.filter((F.col(LINE) > 1) & (F.trim("value") != "")).join(headers, FILE)
    out = valid_or_reason(body.select(F.col(FILE).alias(SOURCE_FILE), LINE, "__ll_fits", "value"), schema,
                          strip_quotes=strip_quotes)
    reason = F.when(~F.col("__ll_fits"), F.lit(BAD_HEADER)).otherwise(F.col(REASON))
    names = schema.fieldNames()
    return out.select(SOURCE_FILE, LINE, F.col("value").alias(RAW), *names, reason.alias(REASON))


def split_records(checked: DataFrame, schema: T.StructType = schemas.TRANSACTIONS) -> tuple[DataFrame, DataFrame]:
    """(valid rows with their file, rejects with file, line, reason and raw line)."""
    return (checked.filter(F.col(REASON).isNull()).select(*schema.fieldNames(), SOURCE_FILE),
            checked.filter(F.col(REASON).isNotNull()).select(*REJECT_COLUMNS))


def read_checked_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.TRANSACTIONS,
                     strip_quotes: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects) of CSV files with a header; nothing in them stops the job."""
    lines = tag_source(spark.read.text(path))
    return split_records(checked_lines(lines, schema, strip_quotes), schema)
