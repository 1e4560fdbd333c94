import random
import re

import pytest

from ledgerlift.llm import ngram_join
from ledgerlift.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(id, set size, component) per row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted((tuple(r) for r in ngram_join.near_duplicates(df).collect()), key=str)


def test_tables(docs):
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(edge_docs, no_docs):
    assert got(edge_docs) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert got(no_docs) == []


@pytest.mark.parametrize("short,factor", [(8, 12), (2, 10 ** 9), (2, 0)])
def test_large_groups_of_near_copies(spark, monkeypatch, short, factor):
    """Chains and crowds of near copies, through the ring rounds and without them."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short)
    monkeypatch.setattr(ngram_join, "RING_YIELD", factor)
    rnd, rows = random.Random(2), []
    for g in range(4):
        base = [f"g{g}w{rnd.randint(0, 900)}" for _ in range(90)]
        text = list(base)
        for i in range(45):
            if g % 2:  # a chain: each copy is near the one before only
                text[rnd.randrange(len(text))] = f"c{g}x{i}"
                rows.append((len(rows), " ".join(text)))
            else:      # a crowd: each copy is near the base
                copy = list(base)
                for _ in range(rnd.randint(0, 5)):
                    copy[rnd.randrange(len(copy))] = f"c{g}x{i}y{rnd.random()}"
                rows.append((len(rows), " ".join(copy)))
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == brute(rows)


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] \
        + [(rnd.randint(200, 300), rnd.randint(200, 300)) for _ in range(80)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    single = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {x: find(x) for x in parent if x not in single}


def test_one_per_group(edge_docs, docs, no_docs):
    assert ngram_join.one_per_group(no_docs).collect() == []
    for frame in (docs, edge_docs):
        kept = ngram_join.one_per_group(frame)
        assert kept.columns == frame.columns
        kept = kept.collect()
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        want = brute(rows)
        worded = {c for _, n, c in want if n}
        assert sum(n == 0 for _, n, _ in want) == sum(not shingles(r.text) for r in kept)
        kept_ids = [r.doc_id for r in kept if shingles(r.text)]
        named = [i for i in kept_ids if i is not None]
        assert worded - {None} <= set(named)
        assert {i for i, _, _ in want} >= set(kept_ids)
        # no two kept texts link
        assert all(c[2] == c[0] for c in brute([(i, r.text) for i, r in enumerate(kept)]))


def test_few_and_many_links_join_alike(spark):
    rnd = random.Random(8)
    links = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(230)] + [(i, i + 1) for i in range(1000, 1080)]
    df = spark.createDataFrame(links, "a long, b long")
    assert sorted(map(tuple, components(df).collect())) == sorted(map(tuple, components(df, few_links=0).collect()))


@pytest.mark.parametrize("crowd", [2, 8, 32])
def test_sets_beside_a_crowd(spark, monkeypatch, crowd):
    """Sets that share a crowd's shingles: some link with a member, most with none."""
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    rnd = random.Random(6)
    rows = []
    for g in range(2):
        base = [f"g{g}w{i}" for i in range(60)]
        for i in range(50):
            copy = list(base)
            copy[rnd.randrange(60)] = f"g{g}n{i}"
            rows.append(" ".join(copy))
        for i in range(40):  # beside it: a part of the base and words of its own
            keep = rnd.randint(25, 58)
            rows.append(" ".join(base[:keep] + [f"g{g}s{i}x{j}" for j in range(60 - keep)]))
        rows += [" ".join(base[j:j + 30]) for j in range(0, 30, 3)]
    rows = list(enumerate(rows))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)


def test_null_and_repeated_ids(spark):
    """Many rows without an id, and many under one: a set is read from one row, not from all of them."""
    rnd = random.Random(2)
    rows = []
    for i in range(150):
        text = [f"t{i}w{j}" for j in range(20)]
        near = [*text[:-1], "changed"]
        rows += [(None if i % 2 else 7, " ".join(text)), (None if i % 3 else 7, " ".join(near))]
    rows += [(None, rows[0][1])] * 30 + [(500, rows[1][1])]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)


def test_shared_shingles_are_numbered():
    """The shared tokens of all buckets get distinct numbers of 4 bytes; many tokens keep their hashes."""
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(4)
    tokens, buckets, seen, sets = np.unique(rnd.integers(0, 1 << 63, 900).astype(np.uint64)), 3, {}, {}
    for ids in (ngram_join.id_type(1 << 20), ngram_join.id_type(1 << 31)):
        seen.clear(), sets.clear()
        for bucket, at in ngram_join.by_bucket(tokens, buckets):
            mine = tokens[at]
            table = pa.table({"bucket": pa.array([bucket] * 2, pa.int32()),
                              "tokens": [mine.tobytes(), mine[:len(mine) // 2].tobytes()],
                              "sets": [np.full(len(mine), 7).tobytes(), np.full(len(mine) // 2, 8).tobytes()]})
            for row in ngram_join._with_frequency(buckets, ids)(table).to_pylist():
                number = np.frombuffer(row["tokens"], ids)
                assert len(number) == row["shared"] == len(mine) // 2
                assert (np.frombuffer(row["counts"], ids) == 2).all()
                sets.setdefault(row["key"], []).extend(number.tolist())
        assert len(set(sets[7])) == len(sets[7]) and sorted(sets[7]) == sorted(sets[8])
        assert ids.itemsize == 8 or max(sets[7]) < 1 << 32


def test_only_texts_of_sets_that_can_link_move(spark):
    """Of 900 rows, 30 named by a set, some without an id, one of many equal ones: few others reach the join."""
    from pyspark.sql import functions as F

    texts = spark.createDataFrame([(None if i % 7 == 0 else i % 300, f"text {i % 450}") for i in range(900)],
                                  "doc long, text string").withColumn("at", F.xxhash64("text"))
    named = texts.dropDuplicates(["doc", "at"]).orderBy("at").limit(30)
    live = spark.createDataFrame(named.select(F.hash("doc", "at").cast("long").alias("key"), "doc", "at").collect(),
                                 "key long, doc long, at long")
    want = sorted((r.key, t.text) for r in live.collect() for t in texts.collect() if (t.doc, t.at) == (r.doc, r.at))
    found = ngram_join.rows_of_sets(texts, live)
    assert sorted(map(tuple, found.collect())) == want and len(want) >= 30
    moved = texts.select("*", F.xxhash64("doc", "at").alias("row"))
    bits = spark.sparkContext.broadcast(ngram_join.key_filter(live.select(F.xxhash64("doc", "at").alias("row"))))
    assert len(want) <= moved.mapInArrow(ngram_join._passing(bits), moved.schema).count() <= len(want) + 30
