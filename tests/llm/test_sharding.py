import zlib
from collections import Counter

import pytest

from ledgerlift.llm import sharding


def check(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    by_source = Counter(r.source for r in rows)
    for (source, s), n in Counter((r.source, r.shard) for r in rows).items():
        # a source is off by its own rounding, and by that of the cut, which all sources share
        assert abs(n - by_source[source] * counts[s] / len(rows)) <= 1 + len(by_source) ** 0.5, (source, s)


def test_every_row_once_and_every_shard_like_the_mixture(docs):
    rows = sharding.interleave(docs, 7).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    check(rows, 7)
    assert Counter(r.doc_id for r in rows) == Counter(list(texts))
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "rows")


def test_ranks_follow_the_rule(docs):
    """Fractions are (rank + u) / n in each source, and shards cut their order."""
    rows = sharding.interleave(docs, 5).collect()
    for source in {r.source for r in rows}:
        mine = sorted(r.fraction for r in rows if r.source == source)
        u = (zlib.crc32(f"{sharding.SEED}:{source}".encode()) + 0.5) / 2 ** 32
        assert mine == [(i + u) / len(mine) for i in range(len(mine))]
    order = [r.fraction for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_a_hot_source(spark):
    rows = sharding.interleave(spark.range(3000).selectExpr(
        "id as doc_id", "string(id) as text", "if(id % 3 = 0, 'hot', string(id % 50)) as source"), 9).collect()
    check(rows, 9)


def test_edges(edge_docs, no_docs):
    rows = sharding.interleave(edge_docs, 4).collect()
    assert len(rows) == edge_docs.count()
    check(rows, 4)
    null = [r for r in rows if r.doc_id is None]
    assert {r.size for r in null if r.text_crc32 == 0} == {16}
    assert len(null) == 3
    again = sharding.interleave(edge_docs.repartition(7), 4).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert sharding.interleave(no_docs).collect() == []
    with pytest.raises(ValueError):
        sharding.interleave(no_docs, 0)
