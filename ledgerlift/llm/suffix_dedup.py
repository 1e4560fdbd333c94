"""Passages that repeat across documents, by sparse suffix arrays.

A passage counts from ``MIN_WORDS`` words (A-Z lower-cased) that two documents share.

1. *Sparse suffixes.*  Of every ``MIN_WORDS - K + 1`` neighbouring K-word windows the one
   with the smallest hash is retained (content-selected minimisers, about one word in
   eleven), so two copies of a passage retain the same places in it, wherever they stand.
2. *Repeated beginnings.*  A retained suffix whose first K words begin no suffix of another
   document can't be in a repeated passage.  Those beginnings are counted packed by hash
   bucket; one that many documents of a batch hold leaves it in two entries.
3. *Sort, compare neighbours, extend.*  The suffixes left carry ``MIN_WORDS - K`` words to
   either side.  For each split of these words to the left and right they are sorted by
   beginning, left words and right words; neighbours in that order that agree in all
   of them are a match of ``MIN_WORDS`` words around the place, extended as far to both sides
   as any split agrees.  Longer passages hold further retained places with
   matches of their own; the union of a document's matches is its passages.

So every word of every shared passage of ``MIN_WORDS`` words is found, and no other.

A beginning with more than ``HOT`` suffixes is sorted in several random groups.  Each
settles what matches inside it and passes on one entry per distinct
context, which meet by context in a second exchange.

Defined cases: null, empty and short texts have no passage; repetition inside one
document alone doesn't count; rows equal in id and text are one document; null ids are
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm import words
from ledgerlift.llm.common import bucket_count, freeze, freeze_packed, only, partitions, total_bytes
from ledgerlift.llm.ngram_join import by_bucket

MIN_WORDS = 50
K = 30
SIDE = MIN_WORDS - K
HOT = 4096
GROUP = 16384            # suffixes sorted together, about
PIECE = 4 << 20


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) over each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = best(x[:len(x) - step], x[step:])
        done += step
    return x


def minimisers(gram: np.ndarray, width: int = SIDE + 1) -> np.ndarray:
    """Places that are a smallest value of some ``width`` neighbours (ties: all of them)."""
    if len(gram) < width:
        return np.zeros(0, np.int64)
    low = _slide(gram, width, np.minimum)
    # a place is chosen if it equals the smallest value of a window that holds it
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(_slide(padded, width, np.maximum) == gram)


def suffixes(column: pa.Array):
    """Per row: ``(text hash, 32-bit words, chosen places, hash of the first K words at each)``."""
    for lo, hi, data, offsets in words.slices(column):
        data = words.LOWER[data]
        starts, ends, first = words.spans(data, offsets)
        word = words.hashes(data, starts, ends)
        gram, _, row = words.windows(word, first, K)
        cut = np.searchsorted(row, np.arange(hi - lo + 1))
        text = words.hashes(data, offsets[:-1], offsets[1:])
        small = (word >> np.uint64(32)).astype(np.uint32)
        for i in range(hi - lo):
            part = gram[cut[i]:cut[i + 1]]
            place = minimisers(part)
            yield text[i], small[first[i]:first[i + 1]], place, part[place]


def _keys(doc: pa.Array, text: list) -> np.ndarray:
    """A key of (id, text) per row."""
    ids = doc.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
    null = doc.is_null().to_numpy(zero_copy_only=False).astype(np.uint64)
    return words.mix(np.array(text, np.uint64) + words.mix(ids * np.uint64(2) + null)).view(np.int64)


_TYPES = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("gram", pa.int64()), ("total", pa.int64()),
                    ("grams", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])


def _rows(**columns):
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns
                                       else pa.nulls(n, f.type) for f in _TYPES], schema=_TYPES)


def _beginnings(buckets: int):
    """mapInArrow: (doc, text) -> packed (beginning, document) entries, and the pairs settled here."""
    def emit(grams, keys):
        gram, key = np.concatenate(grams), np.concatenate(keys)
        order = np.lexsort((key, gram))
        gram, key = gram[order], key[order]
        new = np.r_[True, (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])]
        gram, key = gram[new], key[new]
        first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        size = np.diff(np.r_[first, len(gram)])
        rank = np.arange(len(gram)) - np.repeat(first, size)
        many = np.repeat(size > 1, size)
        if many.any():
            yield _rows(bucket=(np.arange(int(many.sum())) % buckets).astype(np.int32), key=key[many],
                        gram=gram[many].view(np.int64))
        # the first entry carries how many there are here
        count = np.where(rank == 0, np.repeat(size, size), 0)
        sent = rank < 2
        gram, key, count, many = gram[sent], key[sent], count[sent], many[sent]
        count = count * 2 + many  # lowest bit: settled here
        parts = list(by_bucket(gram, buckets))
        yield _rows(bucket=[p[0] for p in parts], grams=[gram[p[1]].tobytes() for p in parts],
                    keys=[key[p[1]].tobytes() for p in parts], counts=[count[p[1]].tobytes() for p in parts])

    def run(batches):
        grams, keys, held = [], [], 0
        for batch in batches:
            texts, found = [], []
            for text, _, _, gram in suffixes(batch.column(1)):
                texts.append(text)
                found.append(gram)
            own = _keys(batch.column(0), texts)
            for key, gram in zip(own, found, strict=True):
                if len(gram):
                    grams.append(gram)
                    keys.append(np.full(len(gram), key, np.int64))
                    held += 16 * len(gram)
                    if held > PIECE:
                        yield from emit(grams, keys)
                        grams, keys, held = [], [], 0
        if grams:
            yield from emit(grams, keys)
    return run


def _repeated(table: pa.Table) -> pa.Table:
    """applyInArrow, one bucket: (key, gram) of repeated beginnings; (gram, total) of very common ones."""
    table = table.combine_chunks()
    settled = table.filter(pc.is_valid(table.column("key"))).select(["key", "gram", "total"])
    packed = table.filter(pc.is_null(table.column("key")))
    gram, key, count = (np.frombuffer(b"".join(packed.column(c).to_pylist()), d) for c, d in
                        (("grams", np.uint64), ("keys", np.int64), ("counts", np.int64)))
    if not len(gram):
        return settled
    order = np.lexsort((key, gram))
    gram, key, count = gram[order], key[order], count[order]
    first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    size = np.diff(np.r_[first, len(gram)])
    several = np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first)
    open_ = np.repeat(several, size) & (count & 1 == 0)
    total = np.add.reduceat(count >> 1, first)
    hot = total > HOT
    found = pa.table({"key": pa.array(key[open_]), "gram": pa.array(gram[open_].view(np.int64)),
                      "total": pa.nulls(int(open_.sum()), pa.int64())})
    common = pa.table({"key": pa.nulls(int(hot.sum()), pa.int64()),
                       "gram": pa.array(gram[first][hot].view(np.int64)), "total": pa.array(total[hot])})
    return pa.concat_tables([settled, found, common])


def _with_key(batches):
    """mapInArrow: (doc, text) -> (key, doc, text)."""
    for batch in batches:
        texts = [words.hashes(words.LOWER[d], o[:-1], o[1:]) for _, _, d, o in words.slices(batch.column(1))]
        key = _keys(batch.column(0), np.concatenate(texts) if texts else [])
        yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0), batch.column(1)], ["key", "doc", "text"])


_SUFFIX = "part int, hot boolean, gram long, key long, doc long, place int, before binary, after binary"


def _contexts(parts: int):
    """mapInArrow: (key, doc, text, grams, totals) -> the suffixes with repeated beginnings, in context."""
    def run(batches):
        for batch in batches:
            grams, totals = batch.column("grams").to_pylist(), batch.column("totals").to_pylist()
            out = {c: [] for c in ("part", "hot", "gram", "key", "doc", "place", "before", "after")}
            rows = zip(suffixes(batch.column("text")), grams, totals, batch.column("key").to_pylist(),
                       batch.column("doc").to_pylist(), strict=True)
            for (_, word, place, gram), wanted, total, key, doc in rows:
                groups = {g: -(-t // HOT) for g, t in zip(wanted, total, strict=True)}
                gram = gram.view(np.int64)
                for p, g in zip(place.tolist(), gram.tolist(), strict=True):
                    if g not in groups:
                        continue
                    n = groups[g]
                    spread = (g * 0x9E3779B97F4A7C15 + (key % n if n > 1 else 0) * 0xC2B2AE3D27D4EB4F) % (1 << 64)
                    out["part"].append((spread >> 32) * parts >> 32)
                    out["hot"].append(n > 1)
                    out["gram"].append(g)
                    out["key"].append(key)
                    out["doc"].append(doc)
                    out["place"].append(p)
                    out["before"].append(word[max(0, p - SIDE):p][::-1].tobytes())
                    out["after"].append(word[p + K:p + MIN_WORDS].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["part"], pa.int32()), pa.array(out["hot"], pa.bool_()),
                 *(pa.array(out[c], pa.int64()) for c in ("gram", "key", "doc")), pa.array(out["place"], pa.int32()),
                 pa.array(out["before"], pa.binary()), pa.array(out["after"], pa.binary())],
                ["part", "hot", "gram", "key", "doc", "place", "before", "after"])
    return run


def _prefix_hashes(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(rows x (SIDE + 1) hashes of the first 0.. SIDE words, words per row)``."""
    size = np.array([len(b) // 4 for b in blobs], np.int64)
    word = np.frombuffer(b"".join(b.ljust(4 * SIDE, b"\0") for b in blobs), np.uint32).reshape(-1, SIDE)
    out = np.zeros((len(blobs), SIDE + 1), np.uint64)
    for i in range(SIDE):
        out[:, i + 1] = words.mix(out[:, i] * words.odd(1) + word[:, i] + np.uint64(1))
    return out, size


_MATCH = "doc long, key long, start int, end int, context long, settled boolean"
_MATCH_TYPES = pa.schema([("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                          ("context", pa.int64()), ("settled", pa.bool_())])


def _compare(table: pa.Table) -> pa.Table:
    """applyInArrow, one group of suffixes: matches, and the open contexts of common beginnings."""
    doc, hot = table.column("doc").combine_chunks(), table.column("hot").to_numpy()
    key, place = table.column("key").to_numpy(), table.column("place").to_numpy().astype(np.int64)
    gram = table.column("gram").to_numpy().view(np.uint64)
    before, left = _prefix_hashes(table.column("before").to_pylist())
    after, right = _prefix_hashes(table.column("after").to_pylist())
    low, high = np.full(len(key), SIDE + 1), np.full(len(key), -1)
    passed = []
    for o in range(SIDE + 1):  # o words to the left, the others to the right
        at = np.flatnonzero((left >= o) & (right >= SIDE - o))
        context = words.mix(gram[at] + before[at, o] * words.odd(2) + after[at, SIDE - o] * words.odd(3)
                            + np.array([o], np.uint64) * words.odd(4))
        order = np.lexsort((key[at], context))
        at, context = at[order], context[order]
        if not len(at):
            continue
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        size = np.diff(np.r_[first, len(at)])
        own = key[at]
        matched = own[first] != own[first + size - 1]   # neighbours of two documents agree
        hit = at[np.repeat(matched, size)]
        low[hit] = np.minimum(low[hit], o)
        high[hit] = np.maximum(high[hit], o)
        common = hot[at[first]]
        if common.any():
            passed.append((at[first][common], context[first][common], matched[common], o))
            # a document that holds an unmatched context more than once is open at each place
            again = np.repeat(common & ~matched, size)
            again[first] = False
            passed.append((at[again], context[again], np.zeros(int(again.sum()), bool), o))
    found = np.flatnonzero(high >= 0)
    out = [pa.table({"doc": doc.take(pa.array(found)), "key": pa.array(key[found]),
                     "start": pa.array(place[found] - high[found], pa.int32()),
                     "end": pa.array(place[found] - low[found] + MIN_WORDS, pa.int32()),
                     "context": pa.nulls(len(found), pa.int64()),
                     "settled": pa.nulls(len(found), pa.bool_())}, schema=_MATCH_TYPES)]
    for at, context, matched, o in passed:
        out.append(pa.table({"doc": doc.take(pa.array(at)), "key": pa.array(key[at]),
                             "start": pa.array(place[at] - o, pa.int32()),
                             "end": pa.array(place[at] - o + MIN_WORDS, pa.int32()),
                             "context": pa.array(context.view(np.int64)), "settled": pa.array(matched)},
                            schema=_MATCH_TYPES))
    return pa.concat_tables(out)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per repeated passage and document: ``id_col, start_word, end_word, n_words``
    (word offsets in the document, end exclusive)."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    buckets = bucket_count(texts, total_bytes(texts, F.col("text")), 32 << 20)
    schema = "bucket int, key long, gram long, total long, grams binary, keys binary, counts binary"
    first = freeze_packed(texts.mapInArrow(_beginnings(buckets), schema).groupBy("bucket").applyInArrow(
        _repeated, "key long, gram long, total long"), "beginnings")
    common = first.filter("total is not null").select(F.col("gram").alias("hot_gram"), "total")
    wanted = first.filter("key is not null")
    suffix_count = wanted.count()
    lists = (wanted.select("key", "gram").join(common, F.col("gram") == F.col("hot_gram"), "left")
             .groupBy("key").agg(F.collect_list(F.struct("gram", F.coalesce("total", F.lit(1)).alias("n"))).alias("x"))
             .selectExpr("key as own", "x.gram as grams", "x.n as totals"))
    parts = max(partitions(docs), -(-suffix_count // GROUP))
    with_lists = (texts.filter(F.octet_length("text") >= 2 * MIN_WORDS - 1)
                  .mapInArrow(_with_key, "key long, doc long, text string")
                  .join(lists, F.col("key") == F.col("own")).drop("own")).dropDuplicates(["key"])
    compared = freeze(with_lists.mapInArrow(_contexts(parts), _SUFFIX)
                      .groupBy("part").applyInArrow(_compare, _MATCH), "suffix-matches")
    # contexts of common beginnings that one group could not settle
    open_ = compared.filter("context is not null")
    met = (open_.groupBy("context").agg(F.min("key").alias("a"), F.max("key").alias("b"))
           .filter("a <> b").select("context"))
    matches = compared.filter("context is null").select("doc", "key", "start", "end").union(
        open_.filter("not settled").join(met, "context", "left_semi").select("doc", "key", "start", "end"))
    # the union of each document's matches
    w = Window.partitionBy("key").orderBy("start", "end")
    runs = matches.withColumn("reached", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("run", F.sum(F.expr("int(reached is null or start > reached)")).over(w))
    spans = runs.groupBy("key", "run").agg(F.first("doc").alias("doc"), F.min("start").alias("start"),
                                           F.max("end").alias("end"))
    return spans.select(F.col("doc").alias(id_col), F.col("start").cast("long").alias("start_word"),
                        F.col("end").cast("long").alias("end_word"),
                        F.expr("cast(end - start as long)").alias("n_words"))
