"""The divergence audit against brute force; levels, flushes and odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerlift.llm import prefix_audit as pa_

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=10, top=10):
    docs = [("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""), lang or "", s or "")
            for t, lang, s in rows]
    df, count, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        terms = TERM.findall(text)
        groups[lang].add(source)
        df.update((lang, t) for t in set(terms))
        count[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for (x, t), n in df.items() if x == lang and n >= min_docs)
        v = len(kept)

        def shares(counter):
            n = sum(counter[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counter[t] + 2) // (n + 2 * v) for t in kept}

        def f(p, q):
            return (p - q) * (p - q) // (p + q)
        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(t, 1, lang, "z", s) for t, lang, s in rows],
                               "text string, n int, lang string, term string, source string").repartition(3)
    return sorted(map(tuple, pa_.audit(df, **options).collect()))


def corpus(n=260, seed=1):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("un", "under", "Übung", "straßen", "counter", "x", "Ünder") for b in
             ("", "a", "able", "bahn", "revolutionaries", "é", "ééé")]
    vocab += ["internationalisation" * 4 + c for c in "abc"] + ["猫" * k for k in (1, 2, 9)]
    rare = ["q" * 3 + f"{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}" for _ in range(300)]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocab)[::rng.choice([1, 1, 1, -1])] for _ in range(rng.randrange(25))]
        words += [rng.choice(rare) for _ in range(3)]
        words = [w.upper() if rng.random() < 0.1 else w for w in words]
        rows.append((rng.choice([" ", "1", ", ", "\n"]).join(words), rng.choice(["en", "en", "de"]),
                     rng.choice(["s0", "s0", "s1", "s2", "Ä", "z"])))
    return rows


ODD = [(None, None, None), ("", "en", "empty"), ("12 34", "fr", "digits"), ("seul", "fr", None), (None, "fr", "s0"),
       ("long" * 100_000, "en", "s0"), ("only one source", "it", "s9")]


@pytest.mark.parametrize("min_docs", [10, 1, 4])
def test_against_brute_force(spark, min_docs):
    rows = corpus() + ODD + corpus()[:20]
    assert run(spark, rows, min_docs=min_docs) == brute(rows, min_docs)


def test_small_buffers_and_tiles(spark, monkeypatch):
    """Counters written in many pieces, many buckets, tiles of two sources."""
    for name, value in (("FLUSH", 50), ("ROWS", 7), ("TILE", 2), ("BUCKET_CELLS", 20)):
        monkeypatch.setattr(pa_, name, value)
    rows = corpus(120, seed=3) + ODD
    assert run(spark, rows) == brute(rows)


def test_partitions_that_are_not_coalesced(spark):
    """Both sides of the pairs' cogroup meet in many partitions too."""
    rows = corpus(120, seed=5) + ODD
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rare_prefixes_stop_early(spark):
    """No term is counted beyond a prefix that is rare already."""
    import numpy as np
    import pyarrow as pa

    rows = [(f"common{i % 3} zebra{chr(97 + i)}long", "en", "s") for i in range(26)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["text", "lang", "source"])
    out = pa.Table.from_batches(list(pa_._count_terms([batch])))
    levels = np.array(out.column("level").to_pylist())
    assert set(levels) == {-1, 0, 1, 2}
    df = spark.createDataFrame(out.to_pandas(), pa_._SCHEMA)
    assert {bytes(r["term"]) for r in pa_.kept_terms(df, 26).collect()} == {b"common"}
    assert pa_.kept_terms(df, 27).count() == 0


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [("a b", "en", "s")], [("a", "en", "s"), ("b", "en", "t")]])
def test_nothing_kept(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_buckets_follow_the_cells_and_pairs_meet_once(spark):
    """More shuffle partitions make no more rows per pair; more sources than a tile holds."""
    rng = random.Random(8)
    rows = [(" ".join(rng.choice("abcdefghij") * 2 for _ in range(9)), rng.choice(["en", "de"]), f"s{i % 90}")
            for i in range(400)]
    groups = spark.createDataFrame([("en", f"s{i}", 10) for i in range(90)], "lang string, source string, v long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        assert pa_.pair_buckets(groups) == 1 and pa_.pair_buckets(groups.limit(0)) == 1
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_tasks_rows_are_one_per_counter():
    """Some MB of text with more than 2^18 counters in one batch: each leaves the task in one row, with its sum."""
    from itertools import islice, product

    import pyarrow as pa
    import pyarrow.compute as pc

    terms = ["".join(x) for x in islice(product("abcdefghijklmnopqrstuvwxyz", repeat=6), 140_000)]
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(terms)] * 4 + [None, "Aaaaaa"], "lang": ["en"] * 4 + ["", None],
                                        "source": ["s"] * 4 + [None, None]})
    out = pa.Table.from_batches(list(pa_._count_terms([batch])))
    keys = ["level", "lang", "source", "term", "complete"]
    assert out.group_by(keys).aggregate([]).num_rows == out.num_rows > 1 << 18
    rows = {tuple(r[k] for k in keys): r["n"] for r in out.filter(pc.equal(out["term"], b"aaaaaa")).to_pylist()}
    assert rows == {(-1, "en", "s", b"aaaaaa", True): 4, (1, "en", None, b"aaaaaa", True): 4,
                    (-1, "", "", b"aaaaaa", True): 1, (1, "", None, b"aaaaaa", True): 1}
