import hashlib
import json
import random
from collections import Counter

import pyarrow as pa
import pytest

from ledgerlift.llm import bpe, words
from ledgerlift.llm.queries import tokenizer_json
from ledgerlift.llm.wordcache import WordCache


@pytest.fixture(scope="module")
def spec():
    return tokenizer_json()


@pytest.fixture(scope="module")
def library(spec):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


@pytest.fixture(scope="module")
def encoder(spec):
    return bpe.Encoder(spec)


def encode(encoder, text, keep=50):
    cache, out = WordCache(encoder.words, keep), []
    for _, _, data, offsets in words.slices(pa.array([text])):
        out += cache.ids_of(data, offsets)[0].tolist()
    return out


HARD = ["", " ", "Hello the café's ﬁne   Worlds 123 <|endoftext|> á §±  ß İ Σας ΑΣ x<|endoftext|>y<|startoftext|>",
        "it's they're we'll I'd 'tis don't''s", "á é b c 　d\x85e\x1cf\x00",
        "日本語テキスト😀👍🏽 x", "aaaa" * 500, "the" * 3000, "Ǆ ŉ ﬀ ẞ K Å º² ×÷ ÀÿÞ", "<|endoftext|", "a<b>|c"]


def test_equals_the_library(encoder, library, spec):
    rnd, texts = random.Random(3), list(HARD)
    for alphabet in ("abcdefghinorstu'", "theandÀÿþªº²×÷ingerionáéß世 '1\t", "aeht", "<|endoftx>A1 "):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 2500))) for _ in range(40)]
    decoder = bpe.Decoder(spec)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encode(encoder, text) == ids, text[:80]
        parts = [decoder.feed(ids[i:i + 3]) for i in range(0, len(ids), 3)]
        assert "".join([*parts, decoder.finish()]) == library.decode(ids, skip_special_tokens=False)


def test_the_stream_emits_before_the_end_in_constant_memory(encoder):
    transducer = encoder.transducer
    piece, out, most = b"thing" * 20_000, [], 0
    for i in range(0, len(piece), 100):
        out += transducer.feed(piece[i:i + 100])
        most = max(most, len(transducer.buffer))
    early = len(out)
    out += transducer.finish()
    assert most <= transducer.size and early > 0.9 * len(out)
    assert out == transducer.merges.merge([*(transducer.inner[b] for b in piece[:-1]), transducer.final[piece[-1]]])


def test_lookahead_of_small_lists():
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([("a", "b")]) == 1
    # taking b from the end by (b, c) lets (a, b) of the other continuation differ
    assert bpe.sufficient_lookahead([("b", "c"), ("a", "bc"), ("a", "b")]) == 2
    assert bpe.sufficient_lookahead([("ab", "c"), ("a", "b")]) is None  # not proper


def test_random_lists_against_whole_merging():
    """The lookahead suffices: streamed ids equal those of merging the whole piece."""
    rnd = random.Random(8)
    for _ in range(60):
        vocab, pairs = [*bpe.byte_symbols()], []
        tokens = list("abc")
        while len(pairs) < 12:
            u, v = rnd.choice(tokens), rnd.choice(tokens)
            if (u, v) not in pairs and u + v not in vocab and len(u + v) <= 6:
                pairs.append((u, v))
                vocab.append(u + v)
                tokens.append(u + v)
        merges = bpe.Merges({"model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(vocab)}, "merges": pairs}})
        transducer = bpe.Transducer(merges)
        for _ in range(10):
            piece = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 400))).encode()
            assert [*transducer.feed(piece), *transducer.finish()] == merges.merge([transducer.inner[b] for b in piece])


def test_byte_decoder_holds_back_unfinished_characters():
    symbols = bpe.byte_symbols()
    spec = json.dumps({"model": {"vocab": {s: i for i, s in enumerate(symbols)}}, "added_tokens": [],
                       "decoder": {"type": "ByteLevel"}})
    decoder, data = bpe.Decoder(spec), "é世😀".encode()
    parts = [decoder.feed([b]) for b in data]
    assert parts == ["", "é", "", "", "世", "", "", "", "😀"] and decoder.finish() == ""
    assert decoder.feed(data[:3]) + decoder.finish() == "é�"


def test_documents(edge_docs, docs, no_docs, library, spec):
    assert bpe.with_digests(bpe.round_trip(no_docs, spec)).collect() == []
    for frame in (docs, edge_docs):
        want = Counter()
        for r in frame.select("doc_id", "text").collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            want[(r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
        assert Counter(map(tuple, bpe.with_digests(bpe.round_trip(frame, spec)).collect())) == want
        two = bpe.decode_documents(bpe.encode_documents(frame, spec), spec)
        assert Counter(map(tuple, bpe.with_digests(two).collect())) == want


def test_an_unfit_tokenizer_is_refused(edge_docs):
    spec = tokenizer_json("byte_bpe_50k.json")
    with pytest.raises(ValueError, match="word by word"):
        bpe.encode_documents(edge_docs, spec)
    with pytest.raises(ValueError, match="word by word"):
        bpe.round_trip(edge_docs, spec)
