"""Token-id files: concatenated ids with Elias-Fano coded document boundaries.

A store is a folder of Parquet files whose rows are *blocks*: runs of documents
in ascending id order.  Parquet carries the blocks because Spark's committer
makes its files whole or absent when an executor is lost, and any store that
Spark reaches can hold them.  A block is one binary value::

    8 bytes   magic "EFTOKEN1"
    4 x u32   bytes per id (2 or 4), documents n, low bits l, words of high bits
    u64       ids in the block (u)
    n x i64   document ids, then ceil(n / 8) bytes of "id is null" bits
    low       n values of l bits (the low halves of the document ends)
    high      u64 words: unary-coded high halves, bit (end >> l) + i is set for document i
    samples   u32: bit position of every 64th set bit of ``high``
    ids       u values of 2 or 4 bytes, little endian

The end of document i is ``(select(high, i) - i) << l | low[i]``; with l =
floor(log2(u / n)) that costs about 2 + log2(u / n) bits a document instead of
64.  ``select`` jumps to the sample before i and scans a few words.

``start`` counts the ids of all documents before.  A block row carries the ids
before it in its range partition, and the partitions' totals (one row per
partition) give the rest.

Defined cases: a null or empty text is the end id alone; null ids come first;
documents of one id are ordered by their text, null first, and equal rows are
interchangeable (rows of one id whose texts begin alike stay in one task); a tokenizer
that can't be read word by word encodes whole texts; texts longer than a block make a block of their own; an empty
table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlift.llm import words
from ledgerlift.llm.common import bucket_count, only, total_bytes
from ledgerlift.llm.wordcache import ENCODE_BYTES, JoinedWords, WholeTexts, by_words, kept

MAGIC = b"EFTOKEN1"
HEAD = "<8sIIIIQ"
BLOCK_IDS = 1 << 20       # a block is closed when it holds this many ids
SAMPLE = 64
TASK_BYTES = 64 << 20     # text sorted and encoded by one task, about
BEGINNING = 64            # characters of a text in the sampled bounds of tasks
END_ID = 2
BLOCK_ROWS = "part int, seq int, ids_before long, n_docs int, n_ids long, block binary"


class EliasFano:
    """Non-decreasing values with select in little space."""

    def __init__(self, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, n: int):
        self.low_bits, self.low, self.high, self.samples, self.n = low_bits, low, high, samples, n

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> low_bits) + np.arange(n)
        plain = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        plain[ones] = 1
        high = np.packbits(plain, bitorder="little").view(np.uint64)
        return cls(low_bits, low, high, ones[::SAMPLE].astype(np.uint32), n)

    def _low(self, i: int) -> int:
        value = 0
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            value |= ((int(self.low[at >> 3]) >> (at & 7)) & 1) << b
        return value

    def select(self, i: int) -> int:
        """The i-th value, touching a few words only."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        word, bits = at >> 6, int(self.high[at >> 6]) >> (at & 63) << (at & 63)
        while left >= bits.bit_count():
            left -= bits.bit_count()
            word += 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        one = (word << 6) + (bits & -bits).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits]
        low = bits.reshape(self.n, self.low_bits).astype(np.int64) << np.arange(self.low_bits)
        return ((ones[:self.n] - np.arange(self.n)) << self.low_bits) + low.sum(axis=1)


def pack(doc_ids: np.ndarray, nulls: np.ndarray, ends: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """One block."""
    ef = EliasFano.of(ends)
    return b"".join((struct.pack(HEAD, MAGIC, width, len(ends), ef.low_bits, len(ef.high), len(ids)),
                     doc_ids.astype("<i8").tobytes(), np.packbits(nulls, bitorder="little").tobytes(),
                     ef.low.tobytes(), ef.high.astype("<u8").tobytes(), ef.samples.astype("<u4").tobytes(),
                     ids.astype(f"<u{width}").tobytes()))


class Block:
    """A block's views: document ids, boundaries and ids, without copying them."""

    def __init__(self, blob: bytes):
        magic, width, n, low_bits, high, u = struct.unpack_from(HEAD, blob)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = struct.calcsize(HEAD)

        def part(dtype, count):
            nonlocal at
            out = np.frombuffer(blob, dtype, count, at)
            at += out.nbytes
            return out
        self.n, self.doc_ids = n, part("<i8", n)
        self.nulls = np.unpackbits(part("u1", -(-n // 8)), bitorder="little")[:n].astype(bool)
        self.ends = EliasFano(low_bits, part("u1", -(-n * low_bits // 8)), part("<u8", high),
                              part("<u4", -(-n // SAMPLE)), n)
        self.ids = part(f"<u{width}", u)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the block."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


def _encoder(tokenizer_json: str) -> JoinedWords | WholeTexts:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(text: str) -> list[int]:
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
    spec = json.loads(tokenizer_json)
    suffix = spec["model"].get("end_of_word_suffix")
    if not suffix or not by_words(spec):
        return WholeTexts(whole)
    special = [t["content"] for t in spec["added_tokens"]]
    # the same model for pieces that are normalised and cut already
    bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {
        "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, spec["pre_tokenizer"]["pretokenizers"][1]]}}))
    bare.no_truncation()
    bare.no_padding()

    def pieces(text: str) -> list[int]:
        return bare.encode_batch_fast([text], add_special_tokens=False)[0].ids
    return JoinedWords(whole, pieces, spec["model"]["vocab"], suffix, special)


def _packer(tokenizer_json: str, end_id: int, width: int):
    """mapInArrow: sorted (doc, text) -> blocks."""
    def run(batches):
        cache = kept(("store", tokenizer_json), lambda: _encoder(tokenizer_json))
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held, count = [], 0

        def close():
            nonlocal seq, before, held, count
            doc, null, sizes, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            block = pack(doc, null, np.cumsum(sizes), ids, width)
            row = {"part": [part], "seq": [seq], "ids_before": [before], "n_docs": [len(doc)],
                   "n_ids": [len(ids)], "block": [block]}
            seq, before, held, count = seq + 1, before + len(ids), [], 0
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([
                ("part", pa.int32()), ("seq", pa.int32()), ("ids_before", pa.int64()),
                ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("block", pa.binary())]))
        for batch in batches:
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            doc = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in words.slices(batch.column(1), ENCODE_BYTES):
                ids, at = cache.ids_of(data, offsets)
                ids = np.insert(ids, at[1:], end_id)
                held.append((doc[lo:hi], null[lo:hi], np.diff(at) + 1, ids))
                count += len(ids)
                if count >= BLOCK_IDS:
                    yield close()
        if held:
            yield close()
    return run


def write_store(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the store to ``path`` (which must not exist)."""
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(True), end_id + 1) <= 1 << 16 else 4
    rows = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    count = bucket_count(rows, total_bytes(rows, F.col("text")), TASK_BYTES)
    # how a text begins has the order of the texts: one id, or none, with many texts is cut too
    (rows.repartitionByRange(count, "doc", F.substring("text", 1, BEGINNING)).sortWithinPartitions("doc", "text")
     .mapInArrow(_packer(tokenizer_json, end_id, width), BLOCK_ROWS)
     .write.option("compression", "zstd").parquet(path))


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``block_start``, the ids in all blocks before each."""
    blocks = spark.read.schema(BLOCK_ROWS).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    # one row per partition of the writing job: a bounded broadcast
    return blocks.join(F.broadcast(offsets), "part").withColumn(
        "block_start", F.col("part_start") + F.col("ids_before"))


def _documents(batches):
    """mapInArrow: (block_start, block) -> documents."""
    for batch in batches:
        for start, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            block = Block(blob)
            ends = block.ends.all()
            begins = np.r_[0, ends[:-1]]
            for lo in range(0, block.n, 1 << 10):  # rows of a block in small batches
                hi = min(lo + (1 << 10), block.n)
                ids = block.ids[begins[lo]:ends[hi - 1]].astype("<u4")
                edges = np.r_[begins[lo:hi], ends[hi - 1:hi]] - begins[lo]
                values = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo, [None, pa.py_buffer((edges * 4).astype(np.int64).tobytes()),
                                                 pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_pydict({
                    "doc": pa.array(block.doc_ids[lo:hi], mask=block.nulls[lo:hi]),
                    "start": pa.array(begins[lo:hi] + start, pa.int64()),
                    "n_tokens": pa.array(ends[lo:hi] - begins[lo:hi], pa.int64()),
                    "ids": values.cast(pa.binary())})


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids``; ids are little-endian unsigned 32-bit integers."""
    return (open_store(spark, path).select("block_start", "block")
            .mapInArrow(_documents, "doc long, start long, n_tokens long, ids binary")
            .withColumnRenamed("doc", id_col))
