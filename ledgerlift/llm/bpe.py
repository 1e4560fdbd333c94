"""BPE by a bounded-lookahead streaming transducer, and incremental decoding.

*Sufficient lookahead.*  Apply the merge rules of a proper merge list one after
another to a text whose continuation is unknown.  The part of the text on which
all continuations agree starts as everything seen; rule ``r = (u, v)`` can only
take the last agreed token from it, and only if that token is ``u`` and what
follows the agreed part is ``v``.  What follows then is a token that begins with
the ``u`` taken by an earlier rule.  So the part lost is at most ``D(r)`` bytes,

    D(r) = |u| + max(D(q) for earlier rules q with v starting with u of q),

and no token that ends at least ``max D`` bytes before the end of what was read
can change.  :func:`sufficient_lookahead` computes that number from the list.

*Transducer.*  Symbols are read into a buffer of constant size; the buffer is
merged, its stable tokens are emitted and their symbols dropped.  A token
boundary splits the rest of the work exactly, since no merge ever crosses it.
Memory does not depend on the length of a piece.  A piece shorter than the buffer is
merged at once: that is the same machine before its first emission.

*Decoding* is a state machine fed with ids: it either writes the tokens' own
strings with a space between (files without a decoder, as ``word_bpe_49k``), or
their bytes, holding back an unfinished UTF-8 sequence.

Normalisation and the cut into pieces are those of the tokenizer's file; for
plain words the same cut is a pattern.  Ids of repeated words and pieces come
from the bounded per-worker pools of :mod:`ledgerlift.llm.wordcache`.

Defined cases: a null or empty text has no ids and decodes to the empty text; a
special token's string in a text is that token, as in the library; ids repeat
row by row for repeated documents; a null id is kept; a list that is not proper
gets an unbounded buffer; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm import words
from ledgerlift.llm.common import only
from ledgerlift.llm.wordcache import ENCODE_BYTES, PieceCache, WordCache, by_words, kept

SHORT = 64               # pieces up to this many symbols are merged by plain search


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Merges:
    """The merge list of a tokenizer file: pair -> rank and result, lookahead, vocabulary."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") \
                or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE models are supported")
        self.vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {(self.vocab[u], self.vocab[v]): r for r, (u, v) in enumerate(pairs)}
        self.result = [self.vocab[u + v] for u, v in pairs]
        self.lookahead = sufficient_lookahead(pairs, self.end)
        self.longest = max(map(len, self.vocab), default=1)

    def merge(self, ids: list[int]) -> list[int]:
        """All merges, lowest rank first, leftmost first."""
        rank, result = self.rank.get, self.result
        none = len(result)
        if len(ids) <= SHORT:
            ids = list(ids)
            ranks = [rank(p, none) for p in zip(ids, ids[1:])]
            while ranks and (low := min(ranks)) < none:
                i = ranks.index(low)
                new = ids[i] = result[low]
                del ids[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = rank((ids[i - 1], new), none)
                if i < len(ranks):
                    ranks[i] = rank((new, ids[i + 1]), none)
            return ids
        ids, last = list(ids), len(ids)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        heap = [(r, i) for i in range(last - 1) if (r := rank((ids[i], ids[i + 1]), none)) < none]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= last or rank((ids[i], ids[j]), none) != r:
                continue
            ids[i], ids[j], after[i] = result[r], -1, after[j]
            if after[j] < last:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < last and (r := rank((ids[a], ids[b]), none)) < none:
                    heappush(heap, (r, a))
        return [x for x in ids if x >= 0]


def sufficient_lookahead(pairs: list[tuple[str, str]], end: str = "") -> int | None:
    """Bytes of context after which a token is final; None if the list isn't proper."""
    made: dict[str, int] = {}
    for r, (u, v) in enumerate(pairs):
        made[u + v] = r  # the last rule that makes it
    if any(made.get(x, -1) >= r for r, pair in enumerate(pairs) for x in pair):
        return None
    deepest: dict[str, int] = {}
    for u, v in pairs:
        tail = v.removesuffix(end) if end else v
        reach = len(u) + max((deepest.get(tail[:k], 0) for k in range(1, len(tail) + 1)), default=0)
        deepest[u] = max(deepest.get(u, 0), reach)
    return max(deepest.values(), default=0)


class Transducer:
    """Reads byte symbols of one piece, emits final token ids."""

    def __init__(self, merges: Merges):
        self.merges, self.buffer = merges, []
        look = merges.lookahead
        self.size = None if look is None else 4 * look + 2 * merges.longest
        # symbol -> id inside a piece and at its end; bytes that each token covers
        self.inner = [merges.vocab[s] for s in byte_symbols()]
        self.final = [merges.vocab[s + merges.end] for s in byte_symbols()]
        self.width = {i: len(t.removesuffix(merges.end) if merges.end else t)
                      for t, i in merges.vocab.items()}

    def feed(self, piece: bytes):
        """Yields the ids that have become final."""
        for b in piece:
            self.buffer.append(b)
            if self.size is not None and len(self.buffer) >= self.size:
                stable, at = len(self.buffer) - self.merges.lookahead, 0
                for token in self.merges.merge([self.inner[x] for x in self.buffer]):
                    if at + self.width[token] > stable:
                        break
                    at += self.width[token]
                    yield token
                del self.buffer[:at]

    def finish(self) -> list[int]:
        """The ids of what is left at the end of the piece."""
        if not self.buffer:
            return []
        ids = [self.inner[x] for x in self.buffer[:-1]]
        ids.append(self.final[self.buffer[-1]])
        self.buffer = []
        return self.merges.merge(ids)

    def encode(self, piece: bytes) -> list[int]:
        if self.size is None or len(piece) < self.size:  # fits the buffer
            self.buffer = piece
            return self.finish()
        return [*self.feed(piece), *self.finish()]


class Encoder:
    """Ids of white-space-free words, from a tokenizer file's text."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        if not by_words(spec):
            raise ValueError("only tokenizers that read a text word by word are supported")
        tokenizer = Tokenizer.from_str(tokenizer_json)
        self.normalizer, self.cutter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.transducer = Transducer(Merges(spec))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.byte = {s: b for b, s in enumerate(byte_symbols())}
        self.words = PieceCache(self.transducer.encode, self.word, list(self.special)).words

    def word(self, text: str) -> list[int]:
        out, at = [], 0
        for m in self.special_at.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self._plain(text[at:]) if at else self._plain(text)

    def _plain(self, text: str) -> list[int]:
        encode, out = self.transducer.encode, []
        for piece, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(text)):
            out += encode(bytes(map(self.byte.__getitem__, piece)))
        return out


class Decoder:
    """Incremental ids -> text."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        self.token = {i: t for t, i in spec["model"]["vocab"].items()} \
            | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.as_bytes = spec.get("decoder") is not None
        if self.as_bytes and spec["decoder"]["type"] != "ByteLevel":
            raise ValueError("only byte-level decoders are supported")
        self.byte = {s: b for b, s in enumerate(byte_symbols())}
        self.reset()

    def reset(self) -> None:
        self.started = False
        self.partial = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        """The text that these ids complete."""
        tokens = [t for i in ids if (t := self.token.get(i)) is not None]
        if self.as_bytes:
            return self.partial.decode(bytes(self.byte[c] for t in tokens for c in t if c in self.byte))
        text = " ".join(tokens)
        if self.started and tokens:
            text = " " + text
        self.started = self.started or bool(tokens)
        return text

    def finish(self) -> str:
        """What is left, if the ids end inside a character; ready for the next text."""
        rest = self.partial.decode(b"", final=True) if self.as_bytes else ""
        self.reset()
        return rest


def _encode(tokenizer_json: str):
    """mapInArrow: (doc, text) -> (doc, ids)."""
    def run(batches):
        cache = kept(("bpe", tokenizer_json), lambda: WordCache(Encoder(tokenizer_json).words))
        for batch in batches:
            for lo, hi, data, offsets in words.slices(batch.column(1), ENCODE_BYTES):
                ids, at = cache.ids_of(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi],
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view(np.int32)))],
                    ["doc", "ids"])
    return run


DECODE_RUN = 1 << 16      # ids fed to the decoder at a time
DECODE_ROWS = 500         # documents returned at a time


def _decode(tokenizer_json: str):
    """mapInArrow: (doc, ids) -> (doc, ids, decoded)."""
    def run(batches):
        decoder = kept(("ids", tokenizer_json), lambda: Decoder(tokenizer_json))
        decoder.reset()
        for whole in batches:
            for lo in range(0, len(whole), DECODE_ROWS):
                batch, out = whole.slice(lo, DECODE_ROWS), []
                for ids in batch.column(1):
                    values = ids.values.to_numpy() if ids.is_valid else ()
                    parts = [decoder.feed(values[i:i + DECODE_RUN].tolist())
                             for i in range(0, len(values), DECODE_RUN)]
                    out.append("".join([*parts, decoder.finish()]))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())],
                                                 ["doc", "ids", "decoded"])
    return run


def encode_documents(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``id_col, ids`` (array of int): the ids of every whole text."""
    Encoder(tokenizer_json)  # refuses an unfit file before any job
    rows = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    return rows.mapInArrow(_encode(tokenizer_json), "doc long, ids array<int>").withColumnRenamed("doc", id_col)


def decode_documents(encoded: DataFrame, tokenizer_json: str, id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """``id_col, ids, decoded``."""
    rows = only(encoded, doc=id_col, ids=ids_col)
    return rows.mapInArrow(_decode(tokenizer_json), "doc long, ids array<int>, decoded string") \
        .withColumnRenamed("doc", id_col)


def round_trip(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``id_col, ids, decoded``: both steps, one after another in the same worker and slice by slice."""
    Encoder(tokenizer_json)  # refuses an unfit file before any job
    rows = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    encode, decode = _encode(tokenizer_json), _decode(tokenizer_json)
    return rows.mapInArrow(lambda batches: decode(encode(batches)), "doc long, ids array<int>, decoded string") \
        .withColumnRenamed("doc", id_col)


def with_digests(decoded: DataFrame) -> DataFrame:
    """``n_tokens``, and digests of the ids and of the decoded text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
