import random
import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerlift.llm import suffix_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=S.MIN_WORDS):
    """Covered words per distinct (id, text): all windows that two of them share."""
    rows = set(rows)
    words = {r: WORD.findall((r[1] or "").translate(LOW)) for r in rows}
    seen = defaultdict(set)
    for r, w in words.items():
        for i in range(len(w) - least + 1):
            seen[tuple(w[i:i + least])].add(r)
    out = defaultdict(list)
    for r, w in words.items():
        covered = set()
        for i in range(len(w) - least + 1):
            if len(seen[tuple(w[i:i + least])]) > 1:
                covered.update(range(i, i + least))
        if covered:
            out[r[0]].append(sorted(covered))
    return {k: sorted(v) for k, v in out.items()}


def runs(covered):
    cuts = np.flatnonzero(np.diff(covered) > 1) + 1
    return [(int(p[0]), int(p[-1]) + 1) for p in np.split(np.array(covered), cuts)]


def expected(rows):
    return sorted(((doc, *run) for doc, all_ in brute(rows).items() for covered in all_ for run in runs(covered)), key=str)


def got(df):
    return sorted(((r.doc_id, r.start_word, r.end_word) for r in S.repeated_passages(df).collect()), key=str)


def merged(spans):
    """Adjacent spans as one: the brute force can't tell them apart."""
    out = []
    for doc, a, b in sorted(spans, key=lambda s: (str(s[0]), s[1])):
        if out and out[-1][0] == doc and out[-1][2] == a:
            out[-1] = (doc, out[-1][1], b)
        else:
            out.append((doc, a, b))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [4096, 2])
def test_tables(docs, edge_docs, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    for frame in (docs, edge_docs.filter("doc_id is null or doc_id <> 7")):
        assert merged(got(frame)) == merged(expected([(r.doc_id, r.text) for r in frame.collect()]))


@pytest.mark.parametrize("hot", [4096, 5])
def test_planted_passages(spark, monkeypatch, hot):
    """Passages of 49, 50 and more words in many documents, some with longer context in common."""
    monkeypatch.setattr(S, "HOT", hot)
    rnd = random.Random(9)

    def fresh(n):
        return [f"w{rnd.randrange(10 ** 9)}" for _ in range(n)]
    common, rows = fresh(40), []
    for n in (49, 50, 51, 75, 400):
        passage = fresh(n)
        for _ in range(6):
            rows.append(fresh(rnd.randint(0, 60)) + passage + fresh(rnd.randint(0, 60)))
    for _ in range(40):  # 40 common words; pairs share 6 more on either side
        left, right = fresh(6), fresh(6)
        for _ in range(2):
            rows.append(fresh(30) + left + common + right + fresh(30))
    twice = fresh(60)
    rows += [twice + fresh(3) + twice, fresh(500), fresh(20)]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert merged(got(df)) == merged(expected(rows))


def test_minimisers():
    rnd = np.random.default_rng(0)
    for n in (0, 5, 21, 22, 300):
        gram = rnd.integers(0, 50 if n == 300 else 10 ** 9, n).astype(np.uint64)
        want = {i + j for i in range(n - 20) for j in range(21) if gram[i + j] == gram[i:i + 21].min()}
        assert set(S.minimisers(gram).tolist()) == want


def test_no_rows(no_docs):
    assert S.repeated_passages(no_docs).collect() == []
