"""URL verdicts: host and path rules, and a character language-model ratio for the rest.

The longest fitting rule decides a URL.  For the others two smoothed variable-order
Markov models of the URL's characters are compared: one of the URLs that a rule
allows, one of those that a rule blocks.  A character's probability after its
last ``ORDER`` characters is interpolated with the next shorter context, down to
uniform, each with the weight of ``WEIGHT`` sightings, so a context counts the
more the oftener it was seen.  Counts are exact: one row for each distinct context, and
context with its next character, under a 64-bit hash.

The score of a URL is the log-likelihood difference divided by its length.  The
threshold is calibrated on held-out labelled URLs (one in ``FOLD`` by checksum, unused
in the counts): the middle of the scores at which the two error rates add up to
least.  Weights are integers, so scores don't depend on batching.

All counts cover all rows.  What reaches the driver: a histogram, and 24 bytes for each
distinct context or pair of the labelled URLs, which grow with their variety.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged by its characters; an empty one scores 0; if one kind of label is
missing every unruled URL is allowed; repeated rows are judged row by row; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm import words
from ledgerlift.llm.common import only

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict) of the registered query.
RULES = (("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK),
         ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK))

ORDER = 4
WEIGHT = 4.0
FOLD = 5
SCALE = 1 << 16
BINS = 4096
LIMIT = 8.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    host = F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path as one string) and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _ngrams(column: pa.Array):
    """Per slice: ``(offsets, per order the pair and context hash of each character)``."""
    for _, _, data, offsets in words.slices(column):
        code = words.LOWER[data].astype(np.uint64) + np.uint64(1)
        inside = np.arange(len(code)) - np.repeat(offsets[:-1], np.diff(offsets))
        context = np.zeros(len(code), np.uint64)
        out = []
        for k in range(ORDER + 1):
            if k:
                back = np.zeros(len(code), np.uint64)
                back[k:] = code[:-k] if k < len(code) else 0
                back[inside < k] = 0  # before the first character
                context = context * np.uint64(257) + back
            hashed = words.mix(context + words.odd(k))
            out.append((words.mix(hashed + code).view(np.int64), hashed.view(np.int64)))
        yield offsets, out


def _count(batches):
    """mapInArrow: (url, label) -> count of each hash by class; label 1 allows, 0 blocks."""
    for batch in batches:
        for label in (0, 1):
            chosen = batch.column(0).filter(pc.equal(batch.column(1), label))
            for _, orders in _ngrams(chosen):
                key, n = np.unique(np.concatenate([x for order in orders for x in order]), return_counts=True)
                counts = [np.zeros_like(n), np.zeros_like(n)]
                counts[label] = n
                yield pa.RecordBatch.from_pydict({"key": pa.array(key), "block": pa.array(counts[0], pa.int64()),
                                                  "allow": pa.array(counts[1], pa.int64())})


def ngram_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all contexts and pairs, sorted, and their counts by class (0 block, 1 allow)."""
    table = (labelled.mapInArrow(_count, "key long, block long, allow long").groupBy("key")
             .agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).toArrow())
    key, *counts = (table.column(c).to_numpy() for c in ("key", "block", "allow"))
    order = np.argsort(key)
    return key[order], np.stack([c[order] for c in counts])


def _log_probabilities(model, orders) -> np.ndarray:
    """log P of each character under each class."""
    keys, counts = model
    p = np.full((2, len(orders[0][0])), 1 / 257)
    for order in orders:
        pair, context = (counts[:, at] * (keys[at] == x) for x in order
                         for at in [np.minimum(np.searchsorted(keys, x), len(keys) - 1)])
        p = (pair + WEIGHT * p) / (context + WEIGHT)
    return np.log(p)


def score(column: pa.Array, model) -> np.ndarray:
    """Length-normalised log-likelihood difference of each URL."""
    out = [np.zeros(0)]
    for offsets, orders in _ngrams(column):
        block, allow = _log_probabilities(model, orders)
        total = np.r_[0, np.cumsum(np.rint((allow - block) * SCALE).astype(np.int64))]
        out.append((total[offsets[1:]] - total[offsets[:-1]]) / SCALE / np.maximum(np.diff(offsets), 1))
    return np.concatenate(out)


def threshold(scored: DataFrame) -> float:
    """The calibrated cut over (score, label) rows."""
    rows = (scored.withColumn("bin", F.expr(
        f"int(least(greatest(floor((score + {LIMIT}) * {BINS / (2 * LIMIT)}), 0), {BINS - 1}))"))
        .groupBy("label", "bin").count().collect())  # at most 2 * BINS rows
    total = np.zeros((2, BINS), np.int64)
    for r in rows:
        total[r["label"], r["bin"]] += r["count"]
    if not total.any(axis=1).all():
        return 0.0
    # allowed ones under bin b are lost, blocked ones from it on pass
    lost = np.r_[0, np.cumsum(total[1])] / total[1].sum()
    passed = 1 - np.r_[0, np.cumsum(total[0])] / total[0].sum()
    best = np.flatnonzero(lost + passed <= (lost + passed).min() + 1e-12)
    return float(best[len(best) // 2] * 2 * LIMIT / BINS - LIMIT)


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, score`` (score null where a rule decides)."""
    rows = only(pages, page=id_col, url=url_col).withColumn("page", F.col("page").cast("long"))
    host, path = url_parts(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    # the part that the models read: without the scheme
    rows = rows.withColumn("chars", F.coalesce(F.regexp_replace("url", r"(?s)^.*?://", ""), F.lit("")))
    labelled = rows.filter("ruled is not null").select(
        "chars", F.expr(f"int(ruled = '{ALLOW}')").alias("label"),
        (F.crc32(F.col("chars").cast("binary")) % FOLD == 0).alias("held_out"))
    model = ngram_counts(labelled.filter("not held_out").select("chars", "label"))
    known = bool(model[1].any(axis=1).all())
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            values = score(batch.column("chars"), shared.value) if known else np.zeros(len(batch))
            yield batch.drop_columns(["chars"]).append_column("score", pa.array(values, pa.float64()))
    cut = threshold(labelled.filter("held_out").select("chars", "label").mapInArrow(
        scored, "label int, score double")) if known else 0.0
    judged = rows.select("page", "host", "path", "rule", "ruled", "chars").mapInArrow(
        scored, "page long, host string, path string, rule string, ruled string, score double")
    return judged.select(
        F.col("page").alias(id_col), "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") >= cut, ALLOW).otherwise(BLOCK)).alias("verdict"),
        F.when(F.col("ruled").isNull(), F.col("score")).alias("score"))
