"""Quality rules and an importance-style likelihood ratio between two multinomials.

Every word and word pair of a document is hashed into counters, whose number grows with
the square root of the corpus, about as its vocabulary does: ``PER_ROOT`` times the root
of its bytes, and no fewer than ``LEAST``; 131,072 for 1 GB of text, 983,040 for 60 GB, 40
million for 100 TB.
The *target* multinomial is counted over documents that the labels call good
(at most ``SAMPLE`` of them, chosen by the smallest digest of their id); the
*raw* multinomial is counted over all documents.  A document's score is the sum
of ``log target - log raw`` over its n-grams, divided by their number.  Bucket
weights are integers (``log ratio * 2^16``), so a score does not depend on how
rows are grouped into batches.

The threshold is a rule, not a draw: over all scored labelled documents it is
the score that separates good from bad with the fewest errors, a rejected good
document counting ``GOOD_COST`` times; of equally good cuts the lowest wins.
Scores enter that choice through a histogram of ``BINS`` fixed bins, so what
reaches the driver is bounded: the two count tables (16 bytes a counter), the sampled ids
and the histogram.

Passes over the texts, none of which shuffles text: one adds up bytes, one counts (each
task adds up its rows and emits the counters that it met, once), one scores.  The functions
below run these jobs while the plan is built.

Defined cases: a null or empty text has no words and fails the base rules; an
id that is null is never labelled; an id with contradictory labels is unlabelled;
repeated ids are judged row by row; without any good label the score is 0 and
only the base rules decide; without any bad label nothing is rejected by score;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm import words
from ledgerlift.llm.common import freeze, only, total_bytes

LEAST = 1 << 16
PER_ROOT = 4
PART = 1 << 13             # counters per row of the shuffled count tables, at most 2^16
SAMPLE = 1 << 16           # labelled documents used for the target, at most
SMOOTH = 1.0               # added to every bucket
SCALE = 1 << 16
BINS = 4096
LIMIT = 8.0                # scores are binned within -LIMIT to LIMIT
GOOD_COST = 20
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
BASE_FAILED = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def counters(bytes_in: int) -> int:
    """How many counters a corpus of so many bytes gets, a multiple of ``PART``."""
    return max(LEAST, -(-int(PER_ROOT * bytes_in ** 0.5) // PART) * PART)


def bucket_rows(column: pa.Array, size: int):
    """Per slice of rows: the parsed slice, the bucket of each n-gram and the row of each."""
    for lo, hi, data, offsets in words.slices(column):
        starts, ends, first = words.spans(data, offsets)
        word = words.hashes(data, starts, ends)
        pairs, _, pair_row = words.windows(word, first, 2)
        row = np.repeat(np.arange(hi - lo), np.diff(first))
        high = np.concatenate([words.mix(word), pairs]) >> np.uint64(32)
        buckets = (high * np.uint64(size)) >> np.uint64(32)
        yield (lo, hi, data, offsets, starts, ends, first, word), buckets.astype(np.int64), \
            np.concatenate([row, pair_row])


_PARTS = "part int, at binary, raw binary, target binary"
_PART_TYPES = pa.schema([("part", pa.int32()), ("at", pa.binary()), ("raw", pa.binary()), ("target", pa.binary())])


def _packed(parts):
    """Batches of (part, raw, target) tables: the counters met and their counts, in four or eight bytes."""
    rows = []
    for part, raw, target in parts:
        at = np.flatnonzero(raw)
        width = np.uint32 if raw.max() < 1 << 32 else np.uint64
        rows.append((part, at.astype(np.uint16).tobytes(), *(x[at].astype(width).tobytes() for x in (raw, target))))
        if len(rows) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART_TYPES)],
                                             schema=_PART_TYPES)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART_TYPES)],
                                         schema=_PART_TYPES)


def _unpacked(at: bytes, raw: bytes, target: bytes):
    """``(places, raw counts, target counts)`` of one packed row."""
    places = np.frombuffer(at, np.uint16)
    width = np.uint32 if len(raw) == 4 * len(places) else np.uint64
    return places.astype(np.int64), *(np.frombuffer(x, width).astype(np.int64) for x in (raw, target))


def _counter(good: np.ndarray, size: int):
    """mapInArrow: (doc, text) -> this task's two count tables, in parts."""
    def count(batches):
        tables = np.zeros((2, size), np.int64)
        met: tuple[list, list] = ([], [])
        held = 0

        def fold():
            for counts, some in zip(tables, met):
                if some:
                    counts += np.bincount(np.concatenate(some), minlength=size)
                    some.clear()

        for batch in batches:
            doc = batch.column(0)
            known = doc.is_valid().to_numpy(zero_copy_only=False)
            is_good = np.isin(doc.fill_null(0).to_numpy(zero_copy_only=False), good) & known
            for (lo, hi, *_), buckets, row in bucket_rows(batch.column(1), size):
                met[0].append(buckets)
                met[1].append(buckets[is_good[lo:hi][row]])
                held += len(buckets)
                if held >= size:  # a table is gone through once for as many n-grams
                    fold()
                    held = 0
        fold()
        raw, target = tables.reshape(2, -1, PART)
        yield from _packed((int(i), raw[i], target[i]) for i in np.flatnonzero(raw.any(axis=1)))
    return count


def _add_parts(batches):
    """mapInArrow: adds the rows of each part, one batch at a time."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at, *counts = _unpacked(*packed)
            total.setdefault(part, np.zeros((2, PART), np.int64))[:, at] += counts
    yield from _packed((part, raw, target) for part, (raw, target) in total.items())


def clean_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """``doc, good``: one row per id whose labels agree."""
    return (only(labels, doc=id_col, good=label_col).dropna()
            .groupBy("doc").agg(F.min("good").alias("good"), F.max("good").alias("other"))
            .filter("good = other").drop("other"))


def bucket_weights(docs: DataFrame, good: np.ndarray, size: int) -> np.ndarray:
    """Integer log ratios of the target and raw multinomials, one for each of ``size`` counters."""
    rows = (docs.mapInArrow(_counter(good, size), _PARTS)
            .repartition(F.col("part")).mapInArrow(_add_parts, _PARTS).collect())  # 16 bytes a counter
    raw, target = np.full(size, SMOOTH), np.full(size, SMOOTH)
    for r in rows:
        at, more, good_more = _unpacked(r["at"], r["raw"], r["target"])
        raw[r["part"] * PART + at] += more
        target[r["part"] * PART + at] += good_more
    if target.sum() == SMOOTH * size:
        return np.zeros(size, np.int32)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return np.rint(ratio * SCALE).astype(np.int32)


def measure(column: pa.Array, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts, the weight sum and the number of n-grams of each text."""
    out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_repeat_words", "weight", "n_grams")}
    for (lo, hi, data, offsets, starts, ends, first, word), buckets, row in bucket_rows(column, len(weights)):
        out["n_words"].append(np.diff(first))
        out["word_chars"].append(words.per_row(~words.SPACE[data] & ((data & 0xC0) != 0x80), offsets))
        out["n_symbols"].append(words.per_row(SYMBOLS[data], offsets))
        out["n_repeat_words"].append(repeated_words(word, first))
        # whole numbers below 2^53: the float sums are exact
        total = np.bincount(row, weights=weights[buckets], minlength=hi - lo)
        out["weight"].append(total.astype(np.int64))
        out["n_grams"].append(np.bincount(row, minlength=hi - lo))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def repeated_words(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words per row that lie in a window which the row holds twice or more."""
    key, at, row = words.windows(word, first, WINDOW)
    key = words.mix(key + (row + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:]
    edge = np.zeros(len(word) + 1, np.int64)
    hit = at[order[same]]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    return words.per_row(np.cumsum(edge[:-1]) > 0, first)


def dup_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text or "\n" not in text:
        return 0
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    solid = [x for x in lines if x.strip(" \t\n\v\f\r")]
    return len(solid) - len(set(solid))


def _scorer(weights: np.ndarray):
    def score(batches):
        for batch in batches:
            m = measure(batch.column(1), weights)
            lines = [dup_lines(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column(0), "n_words": m["n_words"], "word_chars": m["word_chars"],
                "n_symbols": m["n_symbols"], "n_dup_lines": pa.array(lines, pa.int64()),
                "n_repeat_words": m["n_repeat_words"],
                "score": m["weight"] / SCALE / np.maximum(m["n_grams"], 1)})
    return score


def choose_threshold(scored: DataFrame) -> float:
    """The cut over the labelled rows' score histogram (see the module's text)."""
    label_bins = (scored.filter("good is not null and not base_failed")
                  .withColumn("bin", F.expr(f"int(least(greatest(floor((score + {LIMIT}) * "
                                            f"{BINS / (2 * LIMIT)}), 0), {BINS - 1}))"))
                  .groupBy("bin", (F.col("good") > 0).alias("good")).count().collect())  # <= 2 * BINS
    good, bad = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
    for r in label_bins:
        (good if r["good"] else bad)[r["bin"]] += r["count"]
    if not bad.sum() or not good.sum():
        return -float("inf")
    # cutting below bin b rejects the bins under it
    cost = GOOD_COST * np.r_[0, np.cumsum(good)] + bad.sum() - np.r_[0, np.cumsum(bad)]
    best = np.flatnonzero(cost == cost.min())
    return float(best[0] * 2 * LIMIT / BINS - LIMIT) if best[0] else -float("inf")


def _learn(texts: DataFrame, labels: DataFrame, id_col: str) -> tuple[DataFrame, np.ndarray, float]:
    """Scored (doc, text) rows, the bucket weights and the cut."""
    known = freeze(clean_labels(labels, id_col), "quality-labels")
    good = np.array([r["doc"] for r in known.filter("good > 0")
                     .orderBy(F.md5(F.col("doc").cast("string").cast("binary")), "doc")
                     .limit(SAMPLE).select("doc").collect()], np.int64)  # at most SAMPLE ids
    weights = bucket_weights(texts, good, counters(total_bytes(texts, F.col("text"))))
    scored = texts.mapInArrow(_scorer(weights), "doc long, n_words long, word_chars long, "
                              "n_symbols long, n_dup_lines long, n_repeat_words long, score double")
    scored = freeze(scored.withColumn("base_failed", F.expr(BASE_FAILED))
                    .join(known, "doc", "left"), "quality-scores")
    return scored, weights, choose_threshold(scored)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, the base counts, ``score, base_failed, kept``."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    scored, _, cut = _learn(texts, labels, id_col)
    return scored.select(F.col("doc").alias(id_col), "n_words", "word_chars", "n_symbols",
                         "n_dup_lines", "n_repeat_words", "score", "base_failed",
                         (~F.col("base_failed") & (F.col("score") >= F.lit(cut))).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps.

    The verdict is computed anew where each text lies, so no text is shuffled by id and
    repeated ids stay apart."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    _, weights, cut = _learn(texts, labels, id_col)
    at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            m = measure(batch.column(at), weights)
            score = m["weight"] / SCALE / np.maximum(m["n_grams"], 1)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
            yield batch.filter(pa.array(~failed & (score >= cut)))
    return docs.mapInArrow(keep, T.StructType(docs.schema.fields))
