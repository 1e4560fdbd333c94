import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlift.llm import token_store
from ledgerlift.llm.queries import tokenizer_json
from ledgerlift.session import scratch_path


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 130, 1000])
@pytest.mark.parametrize("top", [0, 1, 3, 1000, 10 ** 9])
def test_elias_fano(n, top):
    rnd = np.random.default_rng(n + top)
    values = np.cumsum(rnd.integers(0, top + 1, n))
    ef = token_store.EliasFano.of(values)
    assert ef.all().tolist() == values.tolist()
    assert [ef.select(i) for i in range(n)] == values.tolist()
    bits = 8 * (ef.low.nbytes + ef.high.nbytes)
    assert bits <= n * (3 + np.log2(max(2, values[-1] / n))) + 128


def test_block_round_trip_and_random_access():
    rnd = random.Random(1)
    docs = [[rnd.randrange(60_000) for _ in range(rnd.choice([0, 1, 5, 200]))] for _ in range(150)]
    ids = np.array([x for d in docs for x in d], np.uint32)
    ends = np.cumsum([len(d) for d in docs])
    null = np.array([i < 2 for i in range(150)])
    for width in (2, 4):
        block = token_store.Block(token_store.pack(np.arange(150), null, ends, ids, width))
        assert [block.document(i).tolist() for i in range(150)] == docs
        assert block.nulls.tolist() == null.tolist() and block.doc_ids.tolist() == list(range(150))
    with pytest.raises(ValueError):
        token_store.Block(b"x" * 64)


def brute(frame, library):
    rows = sorted(((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, out = 0, []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_store(spark, docs, edge_docs, no_docs, monkeypatch):
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    spec = tokenizer_json()
    library = Tokenizer.from_str(spec)
    for frame, block in ((docs, 5000), (edge_docs, 1 << 20), (edge_docs, 10), (no_docs, 10)):
        monkeypatch.setattr(token_store, "BLOCK_IDS", block)
        path = scratch_path(spark, "store-test")
        token_store.write_store(frame, path, spec)
        got = token_store.read_documents(spark, path).select(
            "doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
        assert Counter(map(tuple, got)) == Counter(brute(frame, library))


def test_other_tokenizers_encode_whole_texts(spark, edge_docs):
    """A file that keeps case and white space isn't read word by word."""
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    spec = tokenizer_json("byte_bpe_50k.json")
    library = Tokenizer.from_str(spec)
    path = scratch_path(spark, "store-test")
    token_store.write_store(edge_docs, path, spec)
    got = token_store.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    assert Counter(map(tuple, got)) == Counter(brute(edge_docs, library))


def test_hot_id_is_cut(spark, monkeypatch):
    """A third of the rows without an id, a third under one: several tasks, one order."""
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    rnd = random.Random(3)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, " ".join(str(rnd.random()) for _ in range(20)))
            for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spec, path = tokenizer_json(), scratch_path(spark, "store-test")
    monkeypatch.setattr(token_store, "TASK_BYTES", 30_000)
    token_store.write_store(frame, path, spec)
    most = spark.read.parquet(path).groupBy("part").agg(F.sum("n_docs").alias("n")).agg(F.max("n")).first()[0]
    assert most < 400
    got = token_store.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    assert Counter(map(tuple, got)) == Counter(brute(frame, Tokenizer.from_str(spec)))


def test_a_piece_is_encoded_once():
    """Words that share pieces: the library meets each distinct piece once, and ids are those of whole texts."""
    import json

    from tokenizers import Tokenizer

    from ledgerlift.llm.wordcache import JoinedWords

    spec = tokenizer_json()
    library, model = Tokenizer.from_str(spec), json.loads(spec)["model"]
    met = []

    def encode(text):
        met.extend(text.split())
        return library.encode(text, add_special_tokens=False).ids
    joined = JoinedWords(encode, encode, model["vocab"], model["end_of_word_suffix"], ["<|endoftext|>"])
    plain = [f"{word}{sign}" for word in ("Stone", "\u00c0ge", "x") for sign in ("", ".", ",,", "7", "77")]
    for texts in (plain, plain[::-1] * 2, [*plain, "it's", "<|endoftext|>", "\u65e5"], ["it's"]):
        ids, count = joined.words(texts)
        parts = np.split(ids, np.cumsum(count)[:-1])
        assert [p.tolist() for p in parts] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    pieces = [x for x in met if x not in ("it's", "<|endoftext|>", "\u65e5")]
    assert sorted(pieces) == sorted({"stone", "\u00e0ge", "x", ".", ",,", "7"})


def joined_words(whole, pieces):
    import json

    from ledgerlift.llm.wordcache import JoinedWords

    model = json.loads(tokenizer_json())["model"]
    return JoinedWords(whole, pieces, model["vocab"], model["end_of_word_suffix"], ["<|startoftext|>", "<|endoftext|>"])


def test_many_pieces_are_kept():
    """Pieces of a corpus with more than 400,000 distinct ones are met once, not again slice after slice."""
    met = []

    def encode(text):
        met.append(text.count(" ") + 1)
        return [stop] * met[-1]
    joined = joined_words(encode, encode)
    stop = int(np.flatnonzero(joined.closes)[0])
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = ["".join(x) for x in letters[np.arange(420_000)[:, None] // 26 ** np.arange(4) % 26]]
    for _ in range(2):
        ids, count = joined.words(texts)
        assert len(ids) == 420_000 and (count == 1).all()
    assert sum(met) == 420_000


@pytest.mark.parametrize("equal", [1 << 64, 50])
def test_ids_of_slices(monkeypatch, equal):
    """Whole slices of odd texts, also if many unequal pieces have an equal hash."""
    from tokenizers import Tokenizer

    from ledgerlift.llm import words
    from ledgerlift.llm.token_store import _encoder

    hashes = words.hashes
    monkeypatch.setattr(words, "hashes", lambda *a: hashes(*a) if equal == 1 << 64 else hashes(*a) % np.uint64(equal))
    library, rnd = Tokenizer.from_str(tokenizer_json()), random.Random(5)
    parts = [*"aZ09.,-<>|'\t\n\r\v\f \x00\x1c\x7f µÀÖ×ØÞßö÷ÿİ́ 日\U0001f600",
             " ", " ", " ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "it's", "Stone", "x" * 30 + "yz", "x" * 30 + "zz", "ÉtÉ"]
    encoder = _encoder(tokenizer_json())
    for _ in range(30):
        texts = ["".join(rnd.choices(parts, k=rnd.choice([0, 1, 3, 40]))) for _ in range(rnd.choice([1, 5, 60]))]
        blobs = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, blobs)])
        ids, at = encoder.ids_of(np.frombuffer(b"".join(blobs), np.uint8), offsets)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] \
            == [library.encode(t, add_special_tokens=False).ids for t in texts]
