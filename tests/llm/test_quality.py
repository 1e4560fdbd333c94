import re
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerlift.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            hit.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit),
            n < 10 or 100 * len(hit) > 20 * n)


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_counts(docs, edge_docs, labels):
    for frame in (docs, edge_docs):
        expected = Counter((r.doc_id, *brute(r.text)) for r in frame.select("doc_id", "text").collect())
        got = Counter((r.doc_id, *base(r)) for r in quality.judge(frame, labels).collect())
        assert got == expected


def test_junk_goes_and_clean_text_stays(spark):
    """Held-out accuracy: learn from half of the labels, judge the other half."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judge(docs, labels.filter("doc_id % 2 = 0")).collect()
    held = {r.doc_id: r.quality for r in labels.filter("doc_id % 2 = 1").collect()}
    judged = [(held[r.doc_id], r.kept) for r in rows if r.doc_id in held and not r.base_failed]
    good = [k for q, k in judged if q == 1]
    bad = [k for q, k in judged if q == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_scores_do_not_depend_on_batches(docs, labels):
    one, other = ({r.doc_id: (r.score, r.kept) for r in quality.judge(docs.repartition(n), labels).collect()} for n in (1, 5))
    assert one == other


def test_edges(spark, edge_docs, no_docs, labels):
    assert quality.judge(no_docs, labels).collect() == []
    none = labels.limit(0)
    rows = quality.judge(edge_docs, none).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in rows)
    odd = spark.createDataFrame([(6, 1, "x"), (6, 0, "x"), (9, None, "x"), (None, 1, "x"), (10, 1, "x")],
                                "doc_id long, quality int, good string")
    assert [tuple(r) for r in quality.clean_labels(odd).collect()] == [(10, 1)]
    assert quality.judge(edge_docs, odd).count() == edge_docs.count()


def test_kept_documents_are_the_kept_rows(edge_docs, docs, labels):
    for frame in (docs, edge_docs):
        want = Counter(r.doc_id for r in quality.judge(frame, labels).collect() if r.kept)
        kept = quality.kept_documents(frame, labels)
        assert kept.columns == frame.columns
        assert Counter(r.doc_id for r in kept.collect()) == want


def test_weights_are_the_log_ratio_of_plain_counts(docs, labels):
    """The counted tables, packed, shuffled and added up, against a loop over the texts."""
    rows = docs.select("doc_id", "text").collect()
    good = np.array([r.doc_id for r in labels.collect() if r.quality == 1], np.int64)
    size = 3 * quality.PART
    raw, target = np.full(size, quality.SMOOTH), np.full(size, quality.SMOOTH)
    for r in rows:
        for _, buckets, _ in quality.bucket_rows(pa.array([r.text], pa.string()), size):
            np.add.at(raw, buckets, 1)
            if r.doc_id in set(good.tolist()):
                np.add.at(target, buckets, 1)
    want = np.rint((np.log(target / target.sum()) - np.log(raw / raw.sum())) * quality.SCALE)
    texts = docs.select("doc_id", "text")
    for parts in (1, 6):
        got = quality.bucket_weights(texts.repartition(parts), good, size)
        assert np.abs(got - want).max() <= 1 and len(got) == size


def test_counters_grow_with_the_corpus():
    sizes = [quality.counters(10 ** k) for k in range(15)]
    assert sizes == sorted(sizes)
    assert sizes[0] == quality.LEAST and sizes[14] > 9 * sizes[12] > 80 * sizes[10]
    assert all(n % quality.PART == 0 for n in sizes)


def test_packed_counts_keep_wide_and_narrow_numbers():
    for top in (7, (1 << 32) + 5):
        raw, target = np.zeros(quality.PART, np.int64), np.zeros(quality.PART, np.int64)
        raw[[0, 5, quality.PART - 1]] = [1, top, 3]
        target[5] = top - 1
        batch, = quality._packed([(4, raw, target)])
        part, *packed = (c[0].as_py() for c in batch.columns)
        at, more, good = quality._unpacked(*packed)
        assert part == 4 and at.tolist() == [0, 5, quality.PART - 1]
        assert more.tolist() == [1, top, 3] and good.tolist() == [0, top - 1, 0]
