"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A document's fingerprint has bit b set if b is set in over half of the XXH64
hashes of its word shingles.  Two fingerprints of at most ``BITS`` = 4
differing bits differ in at most four of their eight bytes, so they share at
least four *positional bytes* (same byte at the same place).

1. *Classes.*  Equal fingerprints are one node, named by the fingerprint, with
   its smallest document (partial aggregation): exact copies cost nothing more.
2. *Index.*  A posting key is the bytes at three positions.  The 20 position
   triples of :func:`triples` are chosen so that any four positions contain
   one of them: whatever four bytes a pair shares, both stand in one common
   list.  (Lists of a single positional byte would hold 1/256 of all
   fingerprints each, those of a triple 1/2^24.)
3. *Tally and filter.*  In each list the shared positional bytes of a pair are
   counted; pairs with fewer than the guaranteed four go, the others are
   verified bit by bit.  A list is searched from its first fingerprint on:
   what it links to leaves the unvisited rest and is searched next, so a list
   of m near copies takes about m steps, and at most m - 1 links come out.
4. *Long lists.*  A list of more than ``LONG_LIST`` fingerprints never meets in
   one task.  Two fingerprints within four bits have a common neighbour within
   two bits of both; so each member is dealt out under its 821 neighbours in
   the 40 bits that the list doesn't fix, and members under one neighbour (at
   most 821) link.  Exact, and linear in the length of the list.
5. *Components* over the links (distributed, written to the shared folder).

Defined results: null and empty texts, and texts without words, have
fingerprint zero and are linked with each other; fewer than four words are one
shingle; repeated rows count as rows; a null id takes part, and its component
is the smallest id that isn't null (null if there is none); an empty table
gives no rows; extra columns, whatever their names, are not read.
:func:`near_duplicates` runs jobs while its plan is built.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import freeze, only, partitions
from ledgerlift.llm.components import components

WORDS = 4
SEED = 42
BITS = 4
BYTES = 8
LONG_LIST = 8192       # fingerprints of one posting list that are searched in one task
BLOCK = 1 << 16        # shingles hashed, and pairs tallied, together
POSTING = 12           # bytes of a posting
BUCKET_BYTES = 4 << 20


def triples() -> list[tuple[int, int, int]]:
    """Position triples such that any four of the eight positions contain one.

    Turan's system: the positions in three cyclic classes; the triples inside a
    class, and those of two positions of a class and one of the next class."""
    group = [p % 3 for p in range(BYTES)]
    out = []
    for t in combinations(range(BYTES), 3):
        g = [group[p] for p in t]
        pair = next((c for c in g if g.count(c) == 2), None)
        if len(set(g)) == 1 or (pair is not None and (pair + 1) % 3 in g):
            out.append(t)
    return out


TRIPLES = triples()


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text (UTF-8), as an unsigned integer."""
    norm = b" ".join(text.lower().split())  # bytes: A-Z and ASCII white space only
    if not norm:
        return 0
    space = np.flatnonzero(np.frombuffer(norm, np.uint8) == 0x20)
    starts, ends = np.r_[0, space + 1], np.r_[space, len(norm)]
    if len(starts) >= WORDS:
        starts, ends = starts[:len(starts) - WORDS + 1], ends[WORDS - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for lo in range(0, len(starts), BLOCK):
        spans = zip(starts[lo:lo + BLOCK].tolist(), ends[lo:lo + BLOCK].tolist(), strict=True)
        hashes = b"".join([digest(norm[a:b], SEED) for a, b in spans])  # big-endian
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BYTES), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big")


def _fingerprints(batches):
    """mapInArrow: (doc, text) -> (doc, fp); fp is the fingerprint's signed value."""
    for batch in batches:
        text = pc.fill_null(batch.column(1).cast(pa.large_string()), "").cast(pa.large_binary())
        fp = np.array([fingerprint(t.as_py()) for t in text], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc", "fp"])


def _mask(t) -> int:
    return sum(0xFF << 8 * p for p in t)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _key_columns():
    """The 20 posting keys of ``fp``: (triple, the fingerprint with all other bytes zero)."""
    return F.array(*[F.struct(F.lit(i).alias("triple"),
                              F.col("fp").bitwiseAND(F.lit(_signed(_mask(t)))).alias("part"))
                     for i, t in enumerate(TRIPLES)])


def _compact(x: np.ndarray, t) -> np.ndarray:
    """The three bytes of a triple side by side."""
    x = x.view(np.uint64)
    return sum(((x >> np.uint64(8 * p)) & np.uint64(0xFF)) << np.uint64(8 * i) for i, p in enumerate(t))


def _packed(keys: np.ndarray, fps: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Postings by bucket of their list, one row a bucket."""
    spread = (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    bucket = ((spread * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    parts = [p for p in np.split(order, cuts) if len(p)]
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int32()),
        "keys": pa.array([keys[p].astype(np.uint32).tobytes() for p in parts], pa.binary()),
        "fps": pa.array([fps[p].tobytes() for p in parts], pa.binary())})


def _postings(buckets: int):
    """mapInArrow: (fp) -> packed postings of all its lists."""
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            keys = np.concatenate([_compact(fp, t) | np.uint64(i << 24) for i, t in enumerate(TRIPLES)])
            yield _packed(keys, np.tile(fp, len(TRIPLES)), buckets)
    return run


def _listed(buckets: int):
    """mapInArrow: (triple, fp) -> packed postings, of these lists only."""
    def run(batches):
        for batch in batches:
            triple, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keys = np.zeros(len(fp), np.uint64)
            for i in np.unique(triple):
                keys[triple == i] = _compact(fp[triple == i], TRIPLES[i]) | np.uint64(int(i) << 24)
            yield _packed(keys, fp, buckets)
    return run


def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs link: the tally of shared positional bytes, then the verification."""
    both = x ^ y
    shared = (np.ascontiguousarray(both).view(np.uint8).reshape(*both.shape, BYTES) == 0).sum(axis=-1)
    out = shared >= BYTES - BITS
    out[out] = np.bitwise_count(both[out]) <= BITS
    return out


def spanning_links(x: np.ndarray):
    """``(a, b)`` links that join each component of these distinct fingerprints."""
    rest, a, b = x, [], []
    front = x[:0]
    while len(rest) or len(front):
        if not len(front):
            front, rest = rest[:1], rest[1:]
        if not len(rest):
            break
        some, front = front[:max(1, BLOCK // len(rest))], front[max(1, BLOCK // len(rest)):]
        hit = linked(some[:, None], rest[None, :])
        found = hit.any(axis=0)
        a.append(some[hit[:, found].argmax(axis=0)])
        b.append(rest[found])
        front, rest = np.r_[front, rest[found]], rest[~found]
    none = np.zeros(0, np.uint64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def _links(table: pa.Table) -> pa.Table:
    """applyInArrow, one bucket: links that join the components of each of its lists."""
    key = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint32)
    fp = np.frombuffer(b"".join(table.column("fps").to_pylist()), np.uint64)
    order = np.argsort(key, kind="stable")
    key, fp = key[order], fp[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    two = first[size == 2]
    ok = linked(fp[two], fp[two + 1])
    a, b = [fp[two][ok]], [fp[two + 1][ok]]
    for at, m in zip(first[size > 2], size[size > 2], strict=True):
        x, y = spanning_links(fp[at:at + m])
        a.append(x)
        b.append(y)
    a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
    both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
    return pa.table({"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])})


def _neighbours(batches):
    """mapInArrow: (triple, fp) of a long list -> (spot, fp): all spots within two bits."""
    for batch in batches:
        for i in pc.unique(batch.column(0)).to_pylist():
            fp = batch.filter(pc.equal(batch.column(0), i)).column(1).to_numpy().view(np.uint64)
            free = [np.uint64(1 << (8 * p + k)) for p in range(BYTES) if p not in TRIPLES[i] for k in range(8)]
            flips = np.array([0, *free, *[x | y for x, y in combinations(free, 2)]], np.uint64)
            for lo in range(0, len(fp), 256):
                part = fp[lo:lo + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((part[:, None] ^ flips).ravel().view(np.int64)),
                     pa.array(np.repeat(part, len(flips)).view(np.int64))], ["spot", "fp"])


def _long_links(lists: DataFrame) -> DataFrame:
    """Links of the members ``(triple, fp)`` of long lists, through common neighbours.

    At most 821 members meet under one spot."""
    return (lists.mapInArrow(_neighbours, "spot long, fp long").groupBy("spot")
            .agg(F.collect_set("fp").alias("fps")).filter("size(fps) > 1")
            .select(F.array_min("fps").alias("b"), F.explode("fps").alias("a"))
            .filter("a <> b").select("a", "b").distinct())


def fingerprint_links(fps: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """``a, b``: links that join every component of the distinct fingerprints ``fp``."""
    lists = fps.select("fp", F.inline(_key_columns()))
    long = freeze(lists.groupBy("triple", "part").agg(F.count(F.lit(1)).alias("size"))
                  .filter(F.col("size") > long_list).select("triple", "part"), "simhash-long")
    buckets = max(partitions(fps), -(-fps.count() * POSTING * len(TRIPLES) // BUCKET_BYTES))
    packed, schema = "bucket int, keys binary, fps binary", "a long, b long"
    if long.isEmpty():
        return fps.select("fp").mapInArrow(_postings(buckets), packed).groupBy("bucket").applyInArrow(_links, schema)
    short = lists.join(long, ["triple", "part"], "left_anti").select("triple", "fp")
    members = lists.join(long, ["triple", "part"], "left_semi").select("triple", "fp")
    return short.mapInArrow(_listed(buckets), packed).groupBy("bucket").applyInArrow(_links, schema) \
        .union(_long_links(members))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    long_list: int = LONG_LIST) -> DataFrame:
    """One row per document: ``id_col, fingerprint, component_id``."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    rows = freeze(texts.mapInArrow(_fingerprints, "doc long, fp long"), "simhash-rows")
    classes = freeze(rows.groupBy("fp").agg(F.min("doc").alias("doc")), "simhash-classes")
    links = freeze(fingerprint_links(classes.select("fp"), long_list), "simhash-links")
    roots = freeze(components(links), "simhash-roots")
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "doc", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    member = named.join(least, "root").select(F.col("fp").alias("own"), "component_id")
    return rows.join(member, F.col("fp") == F.col("own")).select(
        F.col("doc").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
