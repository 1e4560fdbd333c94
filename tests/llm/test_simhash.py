"""SimHash components against brute force, on both sides of the long-list switch."""

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerlift.llm import simhash


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(id, fingerprint, component) with components by repeated search over all pairs."""
    fp = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                group[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, f"{f:016x}", least.get(find(i))) for i, ((doc, _), f) in enumerate(zip(rows, fp, strict=True))),
                  key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(t, "x", 1, i) for i, t in rows], "text string, fp string, node int, doc_id long")
    return sorted(map(tuple, simhash.near_duplicates(df, **options).collect()), key=str)


def corpus(seed=5, groups=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Äpfel", "STRASSE", "naïve", "x" * 90]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 60, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows) + 100, rng.choice([" ", "\n", "\t \x0b"]).join(copy)))
    return rows


def test_any_four_positions_hold_a_triple():
    from itertools import combinations

    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


@pytest.mark.parametrize("long_list", [simhash.LONG_LIST, 1])
def test_against_brute_force(spark, long_list):
    rows = corpus()
    rows += [(1, None), (2, ""), (3, " \n\t"), (None, rows[0][1]), (None, "only null ids hold this rare text here"),
             (7, rows[3][1]), (7, rows[3][1]), (8, "a b c"), (9, "one two three four five six " * 4000)]
    assert run(spark, rows, long_list=long_list) == brute(rows)


def test_planted_distances():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    for bits in range(1, 8):
        near = base.copy()
        for i in range(50):
            for b in rng.choice(64, bits, replace=False):
                near[i] ^= np.uint64(1 << int(b))
        assert simhash.linked(base, near).all() == (bits <= 4)
        assert simhash.linked(base, near).any() == (bits <= 4)


@pytest.mark.parametrize("long_list", [simhash.LONG_LIST, 5])
def test_dense_group_of_fingerprints(spark, long_list):
    """A chain and a ball of fingerprints that share most bytes: one list holds them all."""
    from pyspark.sql import functions as F

    from ledgerlift.llm.components import components

    rng = np.random.default_rng(9)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 300:
        x = list(fps)[rng.integers(len(fps))]
        for b in rng.choice(64, rng.integers(1, 9), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    group = np.arange(len(fps))
    while True:  # labels spread over links until nothing changes
        new = group.copy()
        for i in range(len(fps)):
            new[i] = group[np.bitwise_count(fps ^ fps[i]) <= 4].min()
        if (new == group).all():
            break
        group = new
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    links = simhash.fingerprint_links(df, long_list)
    got = {r["node"]: r["root"] for r in components(links).collect()}
    label = {int(x): got.get(int(x), int(x)) for x in fps.view(np.int64)}
    want = {}
    for g in np.unique(group):
        members = fps[group == g].view(np.int64)
        want |= {int(m): int(members.min()) for m in members}
    assert label == want
    assert links.agg(F.count("a")).first()[0] <= 20 * 821 * len(fps)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = simhash.near_duplicates(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0
