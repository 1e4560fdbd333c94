"""Near-duplicate join on 5-word shingles by vertical partitioning.

Two documents link when ``100 * |X & Y| >= percent * |X | Y|`` for their sets
of distinct shingles; the result is each document's component under links.

1. *Equal sets are one class.*  A set is named by a 128-bit digest; documents
   are grouped by it (partial aggregation), so thousands of exact copies are
   one node from here on.  A node's key is the first half of its digest.
2. *Sparse counting.*  Under the order of hash values a set's prefix of
   ``n - ceil(t n) + ceil(n / 8)`` shingles must share at least
   ``ceil(ceil(t n) / 8)`` of them with the prefix of any partner (the prefix
   principle with overlap c, c taken for the smallest partner).  Only these
   prefixes (3/8 of the shingles) are dealt out, packed by hash bucket; a
   shingle that many sets hold is counted inside each batch and leaves it in
   at most two entries.  Sets with too few shared shingles can't link and go.
3. *Global order and fragments.*  The texts of the sets left are read again from one row each,
   thinned by a filter before they move.  For these sets, the exact number of sets
   that hold each shingle gives the global order (rarest first).  The order is
   cut into ``FRAGMENTS`` parts of about equal weight and every set into the
   matching segments.  Shingles of one set alone never count towards an overlap.  Shared
   shingles are numbered here: 4 bytes each instead of their hashes' 8 from here on.
4. *Candidates.*  Sets that share a shingle among the rarest ``n - ceil(t n) + 1``
   of both are candidates if sizes and positions still allow enough overlap.
5. *Partial overlaps.*  Candidates meet their segments fragment by fragment, rarest first;
   each fragment counts its own overlap, and the sum per pair decides.  A pair whose sum
   and remaining tokens can't reach the bound goes before the next fragment.

A large group of near copies has quadratically many links, but only its
component is asked for.  Each round verifies a few neighbours per set along a
shuffled ring of every posting list (short lists give all their pairs), merges
components, and so drops the pairs inside one component.  Rounds go on while one in
``RING_YIELD`` sampled pairs links.  The last round verifies all pairs left between different components, so no link that would
join two components is ever skipped.

Every decision is exact but for equal 64-bit shingle hashes (see ``words``).

Defined cases: null, empty or word-less texts have size 0, link with nothing,
and are their own component; a text with one to four words is one shingle; a
null id never names a component unless all its members are null; repeated ids
are judged row by row and share components only by their texts; equal rows get
equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm import words
from ledgerlift.llm.common import bucket_count, drop_frozen, freeze, freeze_packed, only, total_bytes
from ledgerlift.llm.components import components
from ledgerlift.llm.decontaminate import filter_has, key_filter

WORDS = 5
PERCENT = 75
SPARE = 8                # the counting prefix keeps n / SPARE shingles more
FRAGMENTS = 3
SHORT_LIST = 8           # posting lists up to this length are always paired in full
RING_DEGREE = 6          # verified neighbours per set and round while candidates are many
RING_YIELD = 12          # rounds go on while one in so many sampled pairs links
CROWD = 32               # sets of a component that is first met by units of it
HUBS = 8                 # sets of a unit that a set beside the crowd is compared with first
BAND = 1.03              # sizes of a unit's sets differ by less than this factor
PAIR_BLOCK = 1 << 18     # pairs looked at together
PIECE = 4 << 20          # packed bytes a mapper holds before it emits them


def shingle_sets(column: pa.Array, k: int = WORDS):
    """Per row the sorted distinct shingle hashes."""
    for lo, hi, data, offsets in words.slices(column):
        data = words.LOWER[data]
        starts, ends, first = words.spans(data, offsets)
        word = words.hashes(data, starts, ends)
        full, _, row = words.windows(word, first, k)
        few, whole = words.short_rows(word, first, k)
        cut = np.searchsorted(row, np.arange(hi - lo + 1))
        whole = dict(zip(few.tolist(), whole, strict=True))
        for i in range(hi - lo):
            part = full[cut[i]:cut[i + 1]]
            if len(part):
                yield np.unique(part)
            else:
                yield np.array([whole[i]], np.uint64) if i in whole else part


def need(n, percent: int = PERCENT):
    """Smallest overlap that a set of size n can link with."""
    return -(-percent * n // 100)


def _digest(s: np.ndarray) -> tuple[int, int]:
    both = np.array([s.sum(dtype=np.uint64), words.mix(s ^ words.odd(3)).sum(dtype=np.uint64)])
    a, b = words.mix(both + np.array([len(s)], np.uint64) * words.odd(1)).view(np.int64)
    return int(a), int(b)


_MAP_ROWS = ("bucket int, doc long, at long, n long, key long, key2 long, shared long, "
             "tokens binary, sets binary")


def _map_batch(bucket, **columns):
    size = len(bucket)
    types = {"bucket": pa.int32(), "doc": pa.int64(), "at": pa.int64(), "n": pa.int64(), "key": pa.int64(),
             "key2": pa.int64(), "shared": pa.int64(), "tokens": pa.binary(), "sets": pa.binary()}
    columns["bucket"] = bucket
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in types.items()],
        list(types))


def bucket_of(token: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by a second hash of the token, so the token's order doesn't matter."""
    spread = words.mix(token ^ words.odd(5)) >> np.uint64(32)
    return ((spread * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def by_bucket(tokens: np.ndarray, buckets: int):
    """``(bucket, positions)`` of the tokens of each bucket that has any."""
    b = bucket_of(tokens, buckets)
    order = np.argsort(b, kind="stable")
    cuts = np.flatnonzero(np.diff(b[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(b[part[0]]), part


def _prefix_rows(buckets: int, percent: int):
    """mapInArrow: (doc, text, text hash) -> set rows, shared counts, and packed prefixes."""
    def emit(tokens, keys):
        tokens, keys = np.concatenate(tokens), np.concatenate(keys)
        order = np.lexsort((keys, tokens))
        tokens, keys = tokens[order], keys[order]
        keep = np.r_[True, (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1])]
        tokens, keys = tokens[keep], keys[keep]
        head = np.r_[True, tokens[1:] != tokens[:-1]]
        count = np.diff(np.r_[np.flatnonzero(head), len(tokens)])
        many = np.repeat(count > 1, count)
        # counted here already: a token that several sets of this piece hold
        held, times = np.unique(keys[many], return_counts=True)
        rank = np.arange(len(tokens)) - np.repeat(np.flatnonzero(head), count)
        sent = ~many | (rank < 2)
        tokens, keys, many = tokens[sent], keys[sent], many[sent]
        tokens = (tokens & ~np.uint64(1)) | many.astype(np.uint64)  # lowest bit: counted already
        rows = list(by_bucket(tokens & ~np.uint64(1), buckets))
        yield _map_batch([r[0] for r in rows], tokens=[tokens[r[1]].tobytes() for r in rows],
                         sets=[keys[r[1]].tobytes() for r in rows])
        yield _map_batch(bucket_of(held, buckets), key=held.view(np.int64), shared=times)

    def run(batches):
        tokens, keys, held = [], [], 0
        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column(1)):
                n = len(s)
                key = _digest(s) if n else (None, None)
                rows.append((n, *key))
                if n:
                    prefix = s[:n - need(n, percent) + -(-n // SPARE)]
                    tokens.append(prefix)
                    keys.append(np.full(len(prefix), key[0], np.int64).view(np.uint64))
                    held += 16 * len(prefix)
                    if held >= PIECE:
                        yield from emit(tokens, keys)
                        tokens, keys, held = [], [], 0
            n, key, key2 = zip(*rows, strict=True) if rows else ((), (), ())
            yield _map_batch(np.arange(len(rows), dtype=np.int32) % buckets, doc=batch.column(0),
                             at=batch.column(2), n=n, key=key, key2=key2)
        if tokens:
            yield from emit(tokens, keys)
    return run


def _columns(table: pa.Table, name: str, dtype) -> np.ndarray:
    blobs = [x for x in table.column(name).to_pylist() if x]
    return np.frombuffer(b"".join(blobs), dtype) if blobs else np.zeros(0, dtype)


def _count_shared(table: pa.Table) -> pa.Table:
    """applyInArrow, one bucket: set rows pass; per set, its tokens that another set holds too."""
    passed = table.filter(pc.is_null(table.column("tokens"))).drop_columns(["tokens", "sets", "bucket"])
    token, key = _columns(table, "tokens", np.uint64), _columns(table, "sets", np.uint64)
    if not len(token):
        return passed
    counted, token = (token & np.uint64(1)).astype(bool), token & ~np.uint64(1)
    order = np.lexsort((key, token))
    token, key, counted = token[order], key[order], counted[order]
    head = np.r_[True, token[1:] != token[:-1]]
    size = np.diff(np.r_[np.flatnonzero(head), len(token)])
    new_key = np.r_[True, (token[1:] != token[:-1]) | (key[1:] != key[:-1])]
    sets = np.add.reduceat(new_key.astype(np.int64), np.flatnonzero(head))
    # a set that came from several pieces counts a token once; what a piece
    # has counted isn't counted again
    group = np.cumsum(new_key) - 1
    seen = np.zeros(group[-1] + 1, bool)
    seen[group[counted]] = True
    hit = np.repeat(sets > 1, size) & new_key & ~seen[group]
    held, times = np.unique(key[hit], return_counts=True)
    counts = pa.table({"key": pa.array(held.view(np.int64)), "shared": pa.array(times, pa.int64())})
    for name, field in (("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("key2", pa.int64())):
        counts = counts.append_column(name, pa.nulls(len(held), field))
    return pa.concat_tables([passed, counts.select(passed.column_names)])


def _passing(bits):
    """mapInArrow: the rows whose ``row`` key is in a broadcast filter (few others pass, and none is lost)."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(filter_has(bits.value, batch.column("row").to_numpy().view(np.uint64))))
    return run


def rows_of_sets(texts: DataFrame, live: DataFrame) -> DataFrame:
    """``key, text`` of the rows (doc, at) that ``live`` names.

    The texts that move are those that pass a filter of the rows, 16 bits each and 16 MB at most: about
    one text more in seventy of the others while there are fewer than 8 million rows, more beyond."""
    row = F.xxhash64("doc", "at").alias("row")
    bits = texts.sparkSession.sparkContext.broadcast(key_filter(live.select(row)))
    some = texts.select("doc", "at", "text", row)
    some = some.mapInArrow(_passing(bits), some.schema)
    one = live.select(F.col("doc").alias("live_doc"), F.col("at").alias("live_at"), "key")
    # always by a shuffle: a broadcast would keep two Python workers a task, here and behind the join
    return some.join(one.hint("merge"), F.col("doc").eqNullSafe(F.col("live_doc")) & (F.col("at") == F.col("live_at"))) \
        .select("key", "text")


def _segments(buckets: int):
    """mapInArrow: (key, text) -> packed (token, set index) per bucket, whole sets."""
    def run(batches):
        tokens, keys, held, seen = [], [], 0, set()

        def emit():
            token, key = np.concatenate(tokens), np.concatenate(keys)
            rows = list(by_bucket(token, buckets))
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array([r[0] for r in rows], pa.int32()),
                "tokens": pa.array([token[r[1]].tobytes() for r in rows], pa.binary()),
                "sets": pa.array([key[r[1]].tobytes() for r in rows], pa.binary())})
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            for key, s in zip(wanted, shingle_sets(batch.column(1)), strict=True):
                # equal rows of one id: once a task is enough
                if len(s) and key not in seen and _digest(s)[0] == key:
                    seen.add(key)
                    tokens.append(s)
                    keys.append(np.full(len(s), key, np.int64))
                    held += 16 * len(s)
                    if held >= PIECE:
                        yield emit()
                        tokens, keys, held = [], [], 0
        if tokens:
            yield emit()
    return run


def id_type(tokens: int) -> np.dtype:
    """What holds the numbers of the tokens that sets share: 4 bytes while the sets have fewer than
    2^30 tokens in all (buckets number their tokens apart, so the numbers have gaps); else the hashes stay."""
    return np.dtype(np.uint32 if tokens < 1 << 30 else np.uint64)


def _numbered(number: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Distinct 4-byte values, spread evenly, of the tokens that are ``number`` in their bucket."""
    whole = number.astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
    if len(whole) and int(whole.max()) >= 1 << 32:
        raise ValueError("a bucket has more tokens than its numbers hold")
    return whole.astype(np.uint32) * np.uint32(0x9E3779B1)  # odd: one to one


def _with_frequency(buckets: int, ids: np.dtype):
    """applyInArrow, one bucket: (key, tokens, frequencies) of the tokens of two or more sets."""
    return lambda table: _frequencies(table, buckets, ids)


def _frequencies(table: pa.Table, buckets: int, ids: np.dtype) -> pa.Table:
    token, key = _columns(table, "tokens", np.uint64), _columns(table, "sets", np.int64)
    order = np.lexsort((key, token))
    token, key = token[order], key[order]
    if len(token):
        keep = np.r_[True, (token[1:] != token[:-1]) | (key[1:] != key[:-1])]
        token, key = token[keep], key[keep]
    _, inverse, count = np.unique(token, return_inverse=True, return_counts=True)
    often = count[inverse] > 1 if len(token) else np.zeros(0, bool)
    if ids.itemsize == 4 and len(token):
        token = _numbered(inverse, table.column("bucket")[0].as_py(), buckets)
    token, key, count = token[often], key[often], count[inverse][often] if len(token) else count
    order = np.argsort(key, kind="stable")
    token, key, count = token[order], key[order], count[order]
    cuts = np.flatnonzero(np.diff(key)) + 1
    parts = list(zip(np.split(key, cuts), np.split(token, cuts), np.split(count, cuts), strict=True)) \
        if len(key) else []
    return pa.table({
        "key": pa.array([int(k[0]) for k, _, _ in parts], pa.int64()),
        "shared": pa.array([len(k) for k, _, _ in parts], pa.int64()),
        "tokens": pa.array([t.tobytes() for _, t, _ in parts], pa.binary()),
        "counts": pa.array([c.astype(ids).tobytes() for _, _, c in parts], pa.binary())})


def _ordered(ids: np.dtype):
    """applyInArrow, one set: its shared tokens in the global order (frequency, token)."""
    def run(table: pa.Table) -> pa.Table:
        token, count = _columns(table, "tokens", ids), _columns(table, "counts", ids)
        order = np.lexsort((token, count))
        return pa.table({"key": table.column("key")[:1], "n": table.column("n")[:1],
                         "tokens": pa.array([token[order].tobytes()], pa.binary()),
                         "counts": pa.array([count[order].tobytes()], pa.binary())})
    return run


def _fragment_rows(cuts: list[tuple[int, int]], ids: np.dtype):
    """mapInArrow: ordered sets -> a row per set and fragment: its segment, and the tokens after it."""
    def run(batches):
        for batch in batches:
            out = {"key": [], "fragment": [], "tokens": [], "rest": []}
            for key, tokens, counts in zip(*(batch.column(c).to_pylist() for c in ("key", "tokens", "counts")),
                                           strict=True):
                token, count = np.frombuffer(tokens, ids), np.frombuffer(counts, ids)
                at = np.zeros(len(token), np.int64)
                for c, t in cuts:
                    at += (count > c) | ((count == c) & (token >= ids.type(t)))
                for f in range(len(cuts) + 1):
                    out["key"].append(key)
                    out["fragment"].append(f)
                    out["tokens"].append(np.sort(token[at == f]).tobytes())
                    out["rest"].append(int((at > f).sum()))
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(out["key"], pa.int64()), "fragment": pa.array(out["fragment"], pa.int32()),
                "tokens": pa.array(out["tokens"], pa.binary()), "rest": pa.array(out["rest"], pa.int32())})
    return run


# ``crowd``: see _last_pairs; 0 elsewhere
FIELDS = np.dtype([("token", "<u8"), ("key", "<i8"), ("root", "<i8"), ("crowd", "<i8"), ("n", "<i4"), ("left", "<i4")])


def _prefixes(percent: int, ids: np.dtype):
    """mapInArrow: ordered sets -> their prefix among the shared tokens, and how many those are."""
    def run(batches):
        for batch in batches:
            out = {"key": [], "n": [], "shared": [], "tokens": []}
            for key, n, tokens in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "tokens")), strict=True):
                shared = len(tokens) // ids.itemsize
                # unshared tokens come first in the order and take up prefix places
                prefix = min(n - need(n, percent) + 1 - (n - shared), shared)
                if prefix > 0:
                    for column, value in zip(out.values(), (key, n, shared, tokens[:ids.itemsize * prefix]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("key", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("tokens", pa.binary())]))
    return run


def _postings(buckets: int, ids: np.dtype):
    """mapInArrow: prefixes with their root -> packed postings per bucket."""
    def run(batches):
        for batch in batches:
            parts = []
            crowd = batch.column("crowd").to_pylist() if "crowd" in batch.schema.names else [0] * len(batch)
            for key, n, shared, root, tokens, c in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "n", "shared", "root", "tokens")), crowd, strict=True):
                token = np.frombuffer(tokens, ids)
                part = np.zeros(len(token), FIELDS)
                part["crowd"] = c
                part["token"], part["key"], part["root"], part["n"] = token, key, root, n
                part["left"] = shared - np.arange(len(token))
                parts.append(part)
            if parts:
                posting = np.concatenate(parts)
                rows = list(by_bucket(posting["token"], buckets))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([r[0] for r in rows], pa.int32()),
                    "postings": pa.array([posting[r[1]].tobytes() for r in rows], pa.binary())})
    return run


def _lists(table: pa.Table):
    """``(postings, first, size)`` of the bucket's lists with sets of more than one component."""
    return _runs(_columns(table, "postings", FIELDS))


def _runs(posting: np.ndarray):
    posting = posting[np.lexsort((posting["key"], posting["n"], posting["token"]))]
    if not len(posting):
        return posting, np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, posting["token"][1:] != posting["token"][:-1]])
    size = np.diff(np.r_[first, len(posting)])
    mixed = np.minimum.reduceat(posting["root"], first) != np.maximum.reduceat(posting["root"], first)
    return posting, first[mixed], size[mixed]


def _fits(a, b, percent: int) -> np.ndarray:
    """Different components, and sizes and places that allow enough overlap."""
    both = a["n"].astype(np.int64) + b["n"]
    least = -(-percent * both // (100 + percent))
    return (a["root"] != b["root"]) & (np.minimum(a["left"], b["left"]) >= least) \
        & (100 * np.minimum(a["n"], b["n"]).astype(np.int64) >= percent * np.maximum(a["n"], b["n"]))


def _fitting(posting, first, size, percent: int):
    """Blocks ``(a, b)`` of all fitting pairs of these lists (sorted by set size)."""
    for m in np.unique(size[size <= SHORT_LIST]):
        i, j = np.triu_indices(m, 1)
        lists = first[size == m]
        for part in np.array_split(lists, max(1, len(lists) * len(i) // PAIR_BLOCK)):
            a, b = posting[(part[:, None] + i).ravel()], posting[(part[:, None] + j).ravel()]
            ok = _fits(a, b, percent)
            yield a[ok], b[ok]
    for at, m in zip(first[size > SHORT_LIST], size[size > SHORT_LIST], strict=True):
        x = posting[at:at + m]
        for k in range(m - 1):
            top = np.searchsorted(x["n"], 100 * int(x["n"][k]) // percent, "right")
            for lo in range(k + 1, top, PAIR_BLOCK):
                b = x[lo:min(lo + PAIR_BLOCK, top)]
                b = b[_fits(b, x[k], percent)]
                yield np.repeat(x[k:k + 1], len(b)), b


def _ringed(posting, first, size, percent: int, turn: int):
    """Blocks of fitting neighbours along a shuffled ring of each list."""
    for at, m in zip(first, size, strict=True):
        x = posting[at:at + m]
        x = x[np.argsort(words.mix(x["key"].view(np.uint64) ^ (x["token"] + words.odd(turn))))]
        y = np.roll(x, 1)
        ok = _fits(x, y, percent)
        yield x[ok], y[ok]


def _pair_table(blocks) -> pa.Table:
    """Distinct pairs, smaller key first; repeats are forgotten as they come."""
    done, held = [np.zeros((0, 4), np.int64)], 0
    for a, b in blocks:
        swap = a["key"] > b["key"]
        done.append(np.stack([np.where(swap, b["key"], a["key"]), np.where(swap, a["key"], b["key"]),
                              np.where(swap, b["n"], a["n"]), np.where(swap, a["n"], b["n"])],
                             axis=1).astype(np.int64))
        held += len(a)
        if held > 1 << 20:
            done, held = [np.unique(np.concatenate(done), axis=0)], 0
    both = np.unique(np.concatenate(done), axis=0)
    return pa.table({c: pa.array(both[:, i]) for i, c in enumerate(("a", "b", "na", "nb"))})


def _all_pairs(percent: int):
    """applyInArrow: every fitting pair between different components."""
    return lambda table: _pair_table(_fitting(*_lists(table), percent))


def _some_pairs(percent: int, turn: int):
    """applyInArrow: every fitting pair of short lists, ring neighbours in long ones."""
    def run(table: pa.Table) -> pa.Table:
        posting, first, size = _lists(table)
        short = size <= SHORT_LIST
        return _pair_table(chain(_fitting(posting, first[short], size[short], percent),
                                 _ringed(posting, first[~short], size[~short], percent, turn)))
    return run


def _overlap(percent: int, ids: np.dtype):
    """mapInArrow: adds the common tokens of two segments; pairs that can't link any more go."""
    def run(batches):
        for batch in batches:
            both = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            rest = np.minimum(batch.column("rest_a").to_numpy(), batch.column("rest_b").to_numpy())
            here = [len(np.intersect1d(np.frombuffer(x, ids), np.frombuffer(y, ids), assume_unique=True))
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            common = batch.column("common").to_numpy() + np.array(here, np.int64)
            least = -(-percent * both // (100 + percent))
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("a", "b", "na", "nb")}
                                             | {"common": pa.array(common)}).filter(pa.array(common + rest >= least))
    return run


def verified(pairs: DataFrame, fragments: DataFrame, parts: int, percent: int, ids: np.dtype) -> DataFrame:
    """The candidate pairs that link: partial overlaps, fragment after fragment, summed per pair.

    After each fragment the pairs whose sum can no longer reach the bound are dropped; after
    the last, what is left has reached it."""
    pairs = pairs.withColumn("common", F.lit(0).cast("long"))
    for f in range(parts):
        here = fragments.filter(F.col("fragment") == f)
        pairs = (pairs.join(here.selectExpr("key as a", "tokens as x", "rest as rest_a"), "a")
                 .join(here.selectExpr("key as b", "tokens as y", "rest as rest_b"), "b")
                 .mapInArrow(_overlap(percent, ids), "a long, b long, na long, nb long, common long"))
    return pairs.select("a", "b")


_PAIRS = "a long, b long, na long, nb long"


def _by_list(known: DataFrame, buckets: int, ids: np.dtype):
    """Prefixes with their root, as postings grouped by bucket of lists."""
    return known.mapInArrow(_postings(buckets, ids), "bucket int, postings binary").groupBy("bucket")


def _crowd_rows(crowds: bool, percent: int):
    """applyInArrow over lists whose postings know their unit of a crowd (``crowd``; 0: in none).

    ``crowds=False``: fitting pairs of sets that are both in no crowd.
    ``crowds=True``: each set with each unit of another crowd that has a set in one of its lists."""
    def run(table: pa.Table) -> pa.Table:
        posting, first, size = _lists(table)
        if crowds:
            out = [np.zeros((0, 3), np.int64)]
            for at, m in zip(first, size, strict=True):
                x = posting[at:at + m]
                units, one = np.unique(x["crowd"], return_index=True)
                for unit, root in zip(units[units != 0], x["root"][one][units != 0], strict=True):
                    y = x[x["root"] != root]
                    out.append(np.stack([y["key"], np.full(len(y), unit), y["n"].astype(np.int64)], axis=1))
            both = np.unique(np.concatenate(out), axis=0)
            return pa.table({c: pa.array(both[:, i]) for i, c in enumerate(("key", "crowd", "n"))})
        plain = posting[posting["crowd"] == 0]
        return _pair_table(_fitting(*_runs(plain), percent))
    return run


def _members(percent: int):
    """applyInArrow: fitting pairs of a set with the members of a unit that it may link with.

    ``crowd`` is the unit a posting asks for; a member's own posting has 0 there, and its unit as root."""
    def run(table: pa.Table) -> pa.Table:
        posting, first, size = _lists(table)

        def blocks():
            for at, m in zip(first, size, strict=True):
                x = posting[at:at + m]
                asks, has = x[x["crowd"] != 0], x[x["crowd"] == 0]
                has = has[np.argsort(has["root"], kind="stable")]
                lo = np.searchsorted(has["root"], asks["crowd"], "left")
                hi = np.searchsorted(has["root"], asks["crowd"], "right")
                for a, i, j in zip(asks, lo, hi, strict=True):
                    for k in range(i, j, PAIR_BLOCK):
                        b = has[k:min(k + PAIR_BLOCK, j)]
                        b = b[_fits(b, a, percent)]
                        yield np.repeat(np.array([a], FIELDS), len(b)), b
        return _pair_table(blocks())
    return run


def _exploded(ids: np.dtype):
    """mapInArrow: (key, crowd, n, tokens) -> a row per token."""
    def run(batches):
        for batch in batches:
            parts = [np.frombuffer(t, ids) for t in batch.column("tokens").to_pylist()]
            size = np.array([len(p) for p in parts], np.int64)
            if size.sum():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(c).to_numpy(), size)) for c in ("key", "crowd", "n")]
                    + [pa.array(np.concatenate(parts).astype(np.int64))], ["key", "crowd", "n", "token"])
    return run


def _last_pairs(known: DataFrame, fragments: DataFrame, buckets: int, parts: int, percent: int,
                ids: np.dtype) -> DataFrame:
    """Every pair of different components that may still link.

    A component of ``CROWD`` sets or more is first met by units: its sets of about one size.
    A set whose overlap with the *union* of a unit's sets doesn't reach what it needs with the
    smallest of them links with none (one row per set and unit, however many sets the unit has).
    The others are first compared with the unit's ``HUBS`` sets that have the fewest shingles
    of their own: one link joins them to the crowd.  Only what is left meets every member."""
    crowd = freeze(known.groupBy("root").agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") >= CROWD)
                   .select(F.col("root").alias("crowd_root")), "near-crowds")
    if crowd.isEmpty():
        return _by_list(known, buckets, ids).applyInArrow(_all_pairs(percent), _PAIRS).distinct()
    band = F.floor(F.log("n") / F.log(F.lit(BAND)))
    marked = freeze_packed(known.join(crowd, F.col("root") == F.col("crowd_root"), "left").withColumn(
        "crowd", F.when(F.col("crowd_root").isNull(), 0).otherwise(F.xxhash64("root", band))).drop("crowd_root"),
        "near-known")
    members = marked.filter("crowd <> 0")
    units = members.groupBy("crowd").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("root").alias("home"))
    plain = _by_list(marked, buckets, ids).applyInArrow(_crowd_rows(False, percent), _PAIRS).distinct()
    asked = _by_list(marked, buckets, ids).applyInArrow(
        _crowd_rows(True, percent), "key long, crowd long, n long").distinct()
    # sizes must fit; what is needed with the smallest set that does
    least = f"ceil({percent} * (n + greatest(low, ceil({percent} * n / 100))) / {100 + percent})"
    asked = freeze(asked.join(units, "crowd").filter(f"100 * high >= {percent} * n and 100 * n >= {percent} * low")
                   .selectExpr("key", "crowd", f"{least} as n", "home", "n as size"), "near-asked")
    row = "key long, crowd long, n long, token long"
    union = (fragments.join(members.select("key", "crowd", "n"), "key").select("key", "crowd", "n", "tokens")
             .mapInArrow(_exploded(ids), row).select("crowd", "token").distinct())
    own = fragments.join(asked, "key").select("key", "crowd", "n", "tokens").mapInArrow(_exploded(ids), row)
    enough = (own.join(union, ["crowd", "token"]).groupBy("key", "crowd", "n").agg(F.count(F.lit(1)).alias("c"))
              .filter("c >= n").select("key", "crowd"))
    able = freeze(asked.drop("n").join(enough, ["key", "crowd"]), "near-able")
    hubs = members.selectExpr("crowd", "key as hub", "n as hub_size",
                              "row_number() over (partition by crowd order by n - shared, key) as r").filter(f"r <= {HUBS}")
    tried = freeze(able.join(hubs, "crowd").selectExpr(
        "key", "home", "least(key, hub) as a", "greatest(key, hub) as b",
        "if(key < hub, size, hub_size) as na", "if(key < hub, hub_size, size) as nb"), "near-tried")
    hits = tried.join(freeze(verified(tried.select("a", "b", "na", "nb").distinct(), fragments, parts, percent, ids),
                             "near-hits"), ["a", "b"])
    rest = able.join(hits.select("key", "home").distinct(), ["key", "home"], "left_anti").select("key", "crowd")
    asks = marked.drop("crowd").join(rest, "key")
    has = members.withColumn("root", F.col("crowd")).withColumn("crowd", F.lit(0).cast("long"))
    pairs = _by_list(asks.unionByName(has), buckets, ids).applyInArrow(_members(percent), _PAIRS)
    return plain.union(pairs).union(hits.select("a", "b", "na", "nb")).distinct()


def global_cuts(ordered: DataFrame, parts: int, ids: np.dtype) -> list[tuple[int, int]]:
    """Places that cut the global order (frequency, token) into parts of about equal weight.

    Frequencies are first summed by their power of two (at most 64 rows reach
    the driver); a cut inside one power is put at a token value."""
    def run(batches):
        total = np.zeros(64, np.int64)
        for batch in batches:
            for blob in batch.column("counts").to_pylist():
                total += np.bincount(np.log2(np.frombuffer(blob, ids).astype(np.float64)).astype(int), minlength=64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"power": pa.array(at, pa.int32()), "weight": pa.array(total[at])})
    rows = (ordered.select("counts").mapInArrow(run, "power int, weight long")
            .groupBy("power").agg(F.sum("weight").alias("weight")).orderBy("power").collect())
    total, before, cuts = sum(r["weight"] for r in rows), 0, []
    bits = 8 * ids.itemsize
    for r in rows:
        while len(cuts) < parts - 1 and before + r["weight"] > total * (len(cuts) + 1) / parts:
            inside = (total * (len(cuts) + 1) / parts - before) / r["weight"]
            # from this power's first frequency on, in proportion over its range
            span = 1 << r["power"]
            count, rest = divmod(inside * span, 1)
            cuts.append((span + int(count), min(int(rest * 2.0 ** bits), 2 ** bits - 1)))
        before += r["weight"]
    return cuts


def _named_sets(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of (doc, text) rows: ``doc, n, key`` per row, and ``key, component_id, root`` per set."""
    size = total_bytes(texts, F.col("text"))
    buckets = bucket_count(texts, size)

    # 1 and 2: sets, classes and the sparse counts, in one pass over the texts
    texts = texts.select("doc", "text", F.xxhash64("text").alias("at"))
    first = freeze(texts.mapInArrow(_prefix_rows(buckets, percent), _MAP_ROWS)
                   .groupBy("bucket").applyInArrow(
                       _count_shared, "doc long, at long, n long, key long, key2 long, shared long"), "sets")
    rows = first.filter("n is not null")
    # a class is read again from one of its rows: the least by (id, text hash), an id before none
    classes = (rows.filter("n > 0").groupBy("key", "key2", "n")
               .agg(F.min("doc").alias("doc"), F.min(F.struct(F.col("doc").isNull(), "doc", "at")).alias("one")))
    enough = f"shared >= ceil(ceil({percent} * n / 100) / {SPARE})"
    shared = first.filter("shared is not null").groupBy("key").agg(F.sum("shared").alias("shared"))
    live = freeze(classes.join(shared, "key").filter(enough)
                  .selectExpr("key", "n", "one.doc as doc", "one.at as at"), "live-sets")

    # 3: whole sets of what is left, the global order and its fragments
    live_tokens = int(live.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    buckets, ids = max(1, -(-live_tokens // (1 << 20))), id_type(live_tokens)
    counted = freeze_packed(
        rows_of_sets(texts, live).mapInArrow(_segments(buckets), "bucket int, tokens binary, sets binary")
        .groupBy("bucket").applyInArrow(_with_frequency(buckets, ids), "key long, shared long, tokens binary, counts binary"),
        "counted")
    sizes = live.groupBy("key").agg(F.first("n").alias("n"))
    alive = (counted.groupBy("key").agg(F.sum("shared").alias("shared")).join(sizes, "key")
             .filter(f"100 * shared >= {percent} * n").select("key", "n"))
    ordered = freeze_packed(counted.join(alive, "key").groupBy("key").applyInArrow(
        _ordered(ids), "key long, n long, tokens binary, counts binary"), "ordered")
    drop_frozen(counted, live)  # spent tables leave the shared folder
    cuts = global_cuts(ordered, FRAGMENTS, ids)
    fragments = freeze_packed(ordered.mapInArrow(
        _fragment_rows(cuts, ids), "key long, fragment int, tokens binary, rest int"), "fragments")

    # 4 and 5: rounds of candidates, verified by fragment
    prefixes = freeze_packed(ordered.select("key", "n", "tokens").mapInArrow(
        _prefixes(percent, ids), "key long, n long, shared long, tokens binary"), "prefixes")
    drop_frozen(ordered)
    roots, turn, last = None, 0, False
    while True:
        known = (prefixes.withColumn("root", F.col("key")) if roots is None else
                 prefixes.join(roots, F.col("key") == F.col("node"), "left")
                 .withColumn("root", F.coalesce("root", "key"))).select("key", "n", "shared", "root", "tokens")
        if last:
            pairs = _last_pairs(known, fragments, buckets, len(cuts) + 1, percent, ids)
        else:
            pairs = (_by_list(known, buckets, ids).applyInArrow(_some_pairs(percent, turn), _PAIRS).distinct()
                     .selectExpr("*", f"row_number() over (partition by a order by xxhash64(b, {turn}L), b) as r")
                     .filter(f"r <= {RING_DEGREE}").drop("r"))
        pairs = freeze(pairs, "near-pairs")
        n_pairs, n_found = pairs.count(), 0
        if n_pairs:
            found = freeze(verified(pairs, fragments, len(cuts) + 1, percent, ids), "near-links")
            n_found = found.count()
            if n_found:
                links = found if roots is None else found.union(roots.select("node", "root"))
                roots = freeze(components(links), "near-roots")
            drop_frozen(found)
        drop_frozen(pairs)
        if last:
            break
        # once most sampled neighbours fail, what is left hardly links: verify all of it
        last = not n_pairs or RING_YIELD * n_found < n_pairs
        turn += 1

    # each class gets its component's smallest document
    named = classes.groupBy("key").agg(F.min("doc").alias("doc"))
    if roots is None:
        return rows, named.selectExpr("key", "doc as component_id", "key as root")
    linked = roots.join(named, F.col("node") == F.col("key"), "left")
    least = linked.groupBy("root").agg(F.min("doc").alias("component_id"))
    member = linked.select("key", "root").join(least, "root")
    return rows, named.join(member, "key", "left").selectExpr(
        "key", "coalesce(component_id, doc) as component_id", "coalesce(root, key) as root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: ``id_col, n_shingles, component_id``."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    rows, named = _named_sets(texts, percent)
    return rows.select("doc", "n", F.col("key").alias("own")).join(
        named, F.col("own") == F.col("key"), "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest id (nulls last), and of rows
    with that id the one with the smallest text hash.  Rows without words all stay.

    Only the chosen (id, text hash) pairs meet the texts, which are joined once."""
    at, schema = docs.columns.index(text_col), docs.schema
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    rows, named = _named_sets(texts, percent)
    # of each group the smallest (id, key); equal rows of it are thinned below
    chosen = (rows.filter("n > 0").select("doc", "key").join(named.select("key", "root"), "key")
              .groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "key")).alias("x"))
              .selectExpr("x.doc as __doc", "x.key as __key"))

    def keyed(batches):
        for batch in batches:
            key = [_digest(s)[0] if len(s) else None for s in shingle_sets(batch.column(at))]
            yield batch.append_column("__own", pa.array(key, pa.int64()))
    own = docs.mapInArrow(keyed, T.StructType([*schema.fields, T.StructField("__own", T.LongType())]))
    wordless = own.filter("__own is null").drop("__own")
    kept = own.join(chosen, (F.col("__own") == F.col("__key"))
                    & F.col(id_col).cast("long").eqNullSafe(F.col("__doc")), "left_semi")
    columns = [F.col(f"`{c}`") for c in schema.names]
    first = kept.groupBy("__own").agg(F.min(F.struct(*columns)).alias("__row")).select(
        *[F.col(f"__row.`{c}`").alias(c) for c in schema.names])  # partially aggregated
    return first.union(wordless)
