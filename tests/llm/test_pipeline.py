import hashlib
import re
from collections import Counter

import corpus_pipeline
from ledgerlift.llm import ngram_join, quality, secret_scan
from ledgerlift.llm.queries import ORACLE_SQL, QUERIES, tokenizer_json
from tests.llm.test_ngram_join import brute as groups
from tests.llm.test_secret_scan import brute as secrets

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES} == set(range(1, 14)) and len(QUERIES) == 13
    assert set(ORACLE_SQL) <= set(QUERIES)
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_stages_against_brute_force(spark, labels):
    """Each stage's kept rows, from its own input."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "duplicates", "benchmark", "secrets", "encode"]
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        results[name] = (before.collect(), after.collect())
        if name != "encode":
            assert after.columns == columns
        before = after
    rows, kept = results["quality"]
    want = {r.doc_id for r in quality.judge(docs, labels).collect() if r.kept}
    assert {r.doc_id for r in kept} == want and Counter(kept) <= Counter(rows)
    rows, kept = results["duplicates"]
    assert {r.doc_id for r in kept} == {c for _, _, c in groups([(r.doc_id, r.text) for r in rows])}
    rows, kept = results["benchmark"]
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[i:i + 13]) for w in items for i in range(len(w) - 12)}
    bad = {r.doc_id for r in rows if any(tuple(w[i:i + 13]) in grams for w in [r.text.lower().split()]
                                         for i in range(len(w) - 12))}
    assert {r.doc_id for r in rows} - {r.doc_id for r in kept} == bad
    rows, kept = results["secrets"]
    texts = {r.doc_id: r.text for r in kept}
    for r in rows:
        if not secrets(r.text):
            assert texts[r.doc_id] == r.text
        assert not secrets(texts[r.doc_id])
    rows, kept = results["encode"]
    library = Tokenizer.from_str(tokenizer_json())
    for r in kept:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert len(kept) == len(rows)
    run = corpus_pipeline.run(spark, SF)
    assert Counter(run.collect()) == Counter(kept)
    assert ngram_join.PERCENT == 75 and secret_scan.KINDS[3] == "markov"


def test_stages_on_edges(spark, edge_docs, no_docs):
    for frame in (edge_docs, no_docs):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name != "encode":
                assert docs.columns == frame.columns
        docs.collect()
