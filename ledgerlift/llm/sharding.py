"""Sharding by proportional stratified interleaving (native DataFrame plan).

Every source is shuffled with a seeded key and its rows are ranked; a row's
*fractional rank* ``(rank + u) / rows of its source`` says how deep in its
source it lies (u, between 0 and 1, is a checksum of the source's name: with one u
for all, sources of equal size would place their rows at the same fractions, and
many small sources would crowd the same shard).  Sorting all rows by fractional rank interleaves the sources in
proportion, so cutting that order into equal runs gives shards whose source
mixture equals the corpus mixture (each source is off by at most about one row
per shard).  Shard sizes differ by at most one row: the law is ``rows``.

No source is ever gathered in one task.  Both orders -- (source, shuffle key)
and (fractional rank, source, shuffle key) -- are range partitions of narrow
rows (id, source, size, checksum); a position is the partition's offset plus
the index inside the partition, and a rank is a position minus the first
position of its source.  The text itself is read once and never shuffled.

Defined cases: a null text has size 16 and the checksum of the empty string; a
null source is a stratum of its own; repeated ids and whole repeated rows are
ranked by (id, size, checksum), so equal rows are interchangeable; null ids
take part under the key of the empty string; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import only
from ledgerlift.operators.chunking import with_row_position
from ledgerlift.operators.rank import join_null_safe

SHARDS = 40
SEED = "mix-1"
ROW_OVERHEAD = 16


def interleave(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``id_col, source, size, text_crc32, fraction, law, shard, slot``."""
    if shards <= 0:
        raise ValueError("shards must be positive")
    rows = only(docs, doc=id_col, text=text_col, source=source_col).select(
        "doc", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("crc"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc").cast("string"), F.lit("")))
              .cast("binary")).alias("shuffle_key"))
    ties = ["shuffle_key", "doc", "size", "crc"]
    in_source = with_row_position(rows, ["source", *ties], "at")
    per_source = in_source.groupBy("source").agg(F.min("at").alias("first_at"),
                                                 F.count(F.lit(1)).alias("source_rows"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))
    offset = (F.crc32(name.cast("binary")).cast("double") + F.lit(0.5)) / F.lit(2.0 ** 32)
    ranked = join_null_safe(in_source, per_source, ["source"]).select(
        "doc", "source", "size", "crc", "shuffle_key",
        (((F.col("at") - F.col("first_at")).cast("double") + offset)
         / F.col("source_rows").cast("double")).alias("fraction"))
    placed = with_row_position(ranked, ["fraction", "source", *ties], "at")
    total = placed.select(F.count(F.lit(1)).alias("n")).scalar()
    shard = F.expr(f"at * {int(shards)} div total")
    return (placed.withColumn("total", total).withColumn("shard", shard)
            .select(F.col("doc").alias(id_col), "source", "size", F.col("crc").alias("text_crc32"),
                    "fraction", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("at") - F.expr(f"(shard * total + {int(shards) - 1}) div {int(shards)}"))
                    .cast("long").alias("slot")))
