"""Benchmark decontamination by template windows and slot consistency.

A text becomes a sequence of *template tokens*: edge punctuation and case go,
numbers, names and units turn into typed placeholders (slots), tokens without a
letter or digit vanish.  Names are capitalised words inside a sentence and a list of
common given names; units are unit words after a number.  So a question
asked again with other numbers and names has the same template.

1. Every window of ``WINDOW`` template tokens with at least ``LITERALS`` plain words
   is hashed, and every window, rich in plain words or not, by its *real tokens* (words
   without case and edge punctuation, slot values included).  Real tokens don't depend
   on what stands around a word, so verbatim copies match wherever they are quoted or
   wrapped.  The benchmark's hashes set bits in a filter sized by their number, ``FILTER_BYTES``
   at most; a fuller filter lets more windows through and loses none.
2. Document windows that pass the filter -- few, unless the filter is full, and
   then still all that matter -- are hash-joined with the benchmark windows.
3. Matches of one document and item on one diagonal (document position minus item
   position) are one copy.  Its slots must be consistent: each slot value of the item
   stands for one value in the document and vice versa.
4. An inserted or lost word moves the rest of a copy to another diagonal: copies at most
   ``NEAR`` diagonals apart whose slots agree count as one, each item token once.
5. A copy that covers ``COVER`` template tokens, or ``SHARE`` percent of the item, is a
   contamination.

A very common passage spreads over the join by document; what is grouped is one
(document, item, diagonal), which is no longer than the item, and then one row for each
diagonal of a document and item.

Defined cases: null or empty texts, and items without a letter or digit, match nothing;
an item of fewer than ``SHORTEST`` tokens is found only word for word and as a whole, at
the first of its places in a document; an item shorter than a window is one window of its whole length, and
documents are then cut into windows of that length too;
repeated documents are reported row by row, equal items once each; null item ids are
reported as null, null document ids too; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm import words
from ledgerlift.llm.common import freeze_packed, only
from ledgerlift.llm.wordcache import distinct_words

WINDOW = 8
LITERALS = 5
SHORTEST = 5                  # tokens of an item that is found by its template, too
COVER = 13
SHARE = 80
NEAR = WINDOW
FILTER_BITS = 16              # for each benchmark window
FILTER_BYTES = (1 << 21, 1 << 24)  # least and most of the filter
KEEP_WORDS = 300_000

# Fixed word lists.
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen
fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty
ninety hundred thousand million billion dozen""".split())
UNIT_WORDS = frozenset("""mm cm m km metre metres meter meters kilometre kilometres kilometer kilometers
inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce
ounces ton tons ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours
day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees
mph kmh kph watt watts volt volts""".split())
GIVEN_NAMES = frozenset("""alice bob carol david emma frank george helen henry jack james jane john julia
kate kevin laura lisa maria mark mary michael mike nancy nick olivia paul peter rachel robert sam sara
sarah sophia susan thomas tim tom""".split())
NUMBER = re.compile(r"[^\w]*[$€£¥]?[+-]?\d[\d.,:/]*(?:[a-zµ°%]{1,4}|%)?[^\w]*", re.IGNORECASE)
EDGE = re.compile(r"^[\W_]+|[\W_]+$")

LITERAL, NUM, UNIT, NAME = range(4)
PLACEHOLDER = words.mix(np.arange(1, 5, dtype=np.uint64))
REAL = np.uint64(0x9E3779B97F4A7C15)  # sets hashes of real tokens apart from those of templates


def classify(word: str) -> tuple[int, str, bool, bool]:
    """``(kind, core, capitalised, ends a sentence)``; the core of an empty token is ''."""
    core = EDGE.sub("", word)
    ends = word.rstrip("\"'”’)]»").endswith((".", "!", "?", ":"))
    if not core:
        return LITERAL, "", False, ends
    low = core.lower()
    if low in NUMBER_WORDS or (core[0].isdigit() or word[0] in "$€£¥+-") and NUMBER.fullmatch(word):
        return NUM, low, False, ends
    if low in GIVEN_NAMES and core[0].isupper():
        return NAME, low, True, ends
    return (UNIT if low in UNIT_WORDS else LITERAL), low, core[0].isupper() and core[1:].islower(), ends


class Templates:
    """Template tokens of text slices; what is known of a word is kept by task."""

    def __init__(self):
        self.known: dict[bytes, tuple] = {}

    def _facts(self, distinct: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > KEEP_WORDS:
            self.known = {}
        for w in distinct:
            if w not in self.known:
                kind, core, cap, ends = classify(w.decode("utf-8"))
                self.known[w] = (kind, xxhash.xxh64_intdigest(core.encode()), cap, ends, not core)
        kind, value, cap, ends, empty = zip(*map(self.known.__getitem__, distinct), strict=True)
        return [np.array(kind, np.int8), np.array(value, np.uint64), np.array(cap), np.array(ends), np.array(empty)]

    def tokens(self, data: np.ndarray, offsets: np.ndarray):
        """``(template hash, slot value or 0, is literal, first token of each row, real token hash)``."""
        starts, ends_at, first = words.spans(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool), first, np.zeros(0, np.uint64)
        distinct, inverse = distinct_words(data, starts, ends_at)
        kind, value, cap, ends, empty = (x[inverse] for x in self._facts(distinct))
        # a new line or row, or the end of a sentence before it, begins a sentence
        lines = np.r_[0, np.cumsum(data == 10)]
        opens = np.r_[True, (lines[starts[1:]] > lines[ends_at[:-1]]) | ends[:-1]]
        begin = first[:-1][np.diff(first) > 0]
        opens[begin] = True
        full = ~empty
        after_number = np.r_[False, kind[:-1] == NUM]
        after_number[begin] = False
        kind = np.where((kind == UNIT) & ~after_number, LITERAL, kind)
        kind = np.where((kind == LITERAL) & cap & ~opens, NAME, kind)
        literal = kind == LITERAL
        template = np.where(literal, value, PLACEHOLDER[kind])
        slot = np.where(literal, np.uint64(0), value | np.uint64(1))
        before = np.r_[0, np.cumsum(full)]
        return template[full], slot[full], literal[full], before[first], value[full]


def keyed_windows(tokens, widths, whole: bool = False):
    """``(hash, first token, row, width, by real tokens)`` of each window of these widths: by the
    template with ``LITERALS`` plain words, by the real tokens always;
    ``whole``: of the widths below ``WINDOW`` only those that are a whole row."""
    template, _, literal, first, value = tokens
    plain, size, out = np.r_[0, np.cumsum(literal)], np.diff(first), []
    for k in widths:
        for real in (False, True):
            key, at, row = words.windows(value if real else template, first, k)
            ok = real | (plain[at + k] - plain[at] >= LITERALS)
            if whole and k < WINDOW:
                ok &= size[row] == k
            key = words.mix(key + REAL) if real else key
            out.append((key[ok], at[ok], row[ok], np.full(int(ok.sum()), k), np.full(int(ok.sum()), real)))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


_ITEM_ROWS = "item long, copy long, length int, at int, key long, slots binary, real boolean"
_DOC_ROWS = "doc long, copy long, at int, key long, slots binary"


def _rows_of(batch: pa.RecordBatch, templates: Templates, widths, bits: np.ndarray | None):
    """Windows of a batch (id, text): one row each. ``copy`` is a hash of the whole text."""
    for lo, hi, data, offsets in words.slices(batch.column(1)):
        tokens = templates.tokens(data, offsets)
        key, at, row, width, real = keyed_windows(tokens, widths, whole=bits is None)
        length = np.diff(tokens[3])
        if bits is not None:
            hit = first_places(key, at, row, width, filter_has(bits, key))
            key, at, row, width, real = key[hit], at[hit], row[hit], width[hit], real[hit]
        if not len(key):
            continue
        used, back = np.unique(row, return_inverse=True)
        texts = words.hashes(data, offsets[used], offsets[used + 1]).view(np.int64)
        slots = [tokens[1][a:a + w].tobytes() for a, w in zip(at.tolist(), width.tolist(), strict=True)]
        yield {"id": batch.column(0).take(pa.array(row + lo)), "copy": pa.array(texts[back]),
               "length": pa.array(length[row], pa.int32()), "at": pa.array(at - tokens[3][row], pa.int32()),
               "key": pa.array(key.view(np.int64)), "slots": pa.array(slots, pa.binary()), "real": pa.array(real)}


def first_places(key, at, row, width, hit: np.ndarray) -> np.ndarray:
    """``hit``, of windows shorter than ``SHORTEST`` only the first of each row and key: such a
    window is a whole item, so one place says all."""
    hit = hit.copy()
    short = np.flatnonzero(hit & (width < SHORTEST))
    short = short[np.lexsort((at[short], key[short], row[short]))]
    again = (key[short[1:]] == key[short[:-1]]) & (row[short[1:]] == row[short[:-1]])
    hit[short[1:][again]] = False
    return hit


def filter_bytes(windows: int) -> int:
    """A power of two with ``FILTER_BITS`` for each window, within ``FILTER_BYTES``."""
    least, most = FILTER_BYTES
    return min(max(1 << (FILTER_BITS * windows // 8).bit_length(), least), most)


def filter_places(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a filter of ``size`` bytes for each key: from its high and its low bits."""
    high = np.uint64(64 - (8 * size).bit_length() + 1)
    return ((key >> high).astype(np.int64), (key & np.uint64(8 * size - 1)).astype(np.int64))


def filter_has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    found = np.ones(len(key), bool)
    for place in filter_places(key, len(bits)):
        found &= (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
    return found


def _items(batches):
    templates = Templates()
    for batch in batches:
        for r in _rows_of(batch, templates, range(1, WINDOW + 1), None):
            yield pa.RecordBatch.from_pydict({"item": r.pop("id")} | r)


PART = 1 << 16


def _filter_parts(size: int):
    """mapInArrow: window keys -> the parts of this task's filter that have a bit."""
    def run(batches):
        bits = np.zeros(8 * size, bool)
        for batch in batches:
            for place in filter_places(batch.column(0).to_numpy().view(np.uint64), size):
                bits[place] = True
        packed = np.packbits(bits, bitorder="little").reshape(-1, PART)
        at = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_pydict({"part": pa.array(at, pa.int32()),
                                          "bits": pa.array([packed[i].tobytes() for i in at], pa.binary())})
    return run


def _or_parts(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bits = np.frombuffer(bits, np.uint8)
            total[part] = total[part] | bits if part in total else bits
    yield pa.RecordBatch.from_pydict({"part": pa.array(list(total), pa.int32()),
                                      "bits": pa.array([v.tobytes() for v in total.values()], pa.binary())})


def key_filter(keys: DataFrame) -> np.ndarray:
    """The filter of a column of 64-bit keys, ``FILTER_BYTES`` at most, on the driver."""
    size = filter_bytes(keys.count())
    parts = (keys.mapInArrow(_filter_parts(size), "part int, bits binary")
             .repartition("part").mapInArrow(_or_parts, "part int, bits binary").collect())
    bits = np.zeros(size, np.uint8)
    for r in parts:
        bits[r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _documents(bits, widths):
    def run(batches):
        templates = Templates()
        packed = bits.value
        for batch in batches:
            for r in _rows_of(batch, templates, widths, packed):
                del r["length"], r["real"]
                yield pa.RecordBatch.from_pydict({"doc": r.pop("id")} | r)
    return run


_COPY = "doc long, copy long, item long, item_copy long, length int"


def _pairs(theirs: np.ndarray, mine: np.ndarray) -> set[tuple[int, int]]:
    return {(x, y) for x, y in zip(theirs.tolist(), mine.tolist(), strict=True) if x or y}


def _agree(pairs, forward: dict, backward: dict) -> bool:
    """Whether each value stands for one other, in both directions; no pair twice in ``pairs``."""
    return all(forward.get(x, y) == y and backward.get(y, x) == x for x, y in pairs) \
        and len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)


def _copies(table: pa.Table) -> pa.Table:
    """applyInArrow, one (document, item, diagonal): the item tokens (bits) of its longest copy with
    agreeing slots, and the slots; no row without one.

    Windows whose slots contradict the ones before them (in document order) start a new copy;
    in a match by real tokens each slot value of the item stands for itself."""
    at, diagonal = table.column("at").to_numpy(), table.column("diagonal")[0].as_py()
    mine, theirs, real = (table.column(c).to_pylist() for c in ("slots", "item_slots", "real"))
    best, best_pairs = set(), {}
    run: set[int] = set()
    forward: dict[int, int] = {}
    backward: dict[int, int] = {}
    for i in np.lexsort((~np.array(real), at)):
        values = np.frombuffer(theirs[i], np.uint64)
        pairs = _pairs(values, values if real[i] else np.frombuffer(mine[i], np.uint64))
        if not _agree(pairs, forward, backward):
            run, forward, backward = set(), {}, {}
            if not _agree(pairs, forward, backward):
                continue
        forward.update(pairs)
        backward.update((y, x) for x, y in pairs)
        run.update(range(at[i] - diagonal, at[i] - diagonal + len(values)))
        if len(run) > len(best):
            best, best_pairs = run.copy(), forward.copy()
    bits = np.zeros(table.column("length")[0].as_py(), bool)
    bits[list(best)] = True
    out = table.slice(0, min(len(best), 1)).select(["doc", "copy", "item", "item_copy", "length", "diagonal"])
    new = {"bits": np.packbits(bits).tobytes(), "theirs": np.array(list(best_pairs), np.uint64).tobytes(),
           "mine": np.array(list(best_pairs.values()), np.uint64).tobytes()}
    for name, value in new.items():
        out = out.append_column(name, pa.array([value] * len(out), pa.binary()))
    return out


def _joined(table: pa.Table) -> pa.Table:
    """applyInArrow, one (document, item): the most item tokens covered by copies on neighbouring
    diagonals whose slots agree, the longest ones first."""
    table = table.sort_by("diagonal")
    diagonal = table.column("diagonal").to_numpy()
    bits = [np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()]
    size = [int(np.bitwise_count(x).sum()) for x in bits]
    pairs = [_pairs(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(
        table.column("theirs").to_pylist(), table.column("mine").to_pylist(), strict=True)]
    covered, ends = 0, np.searchsorted(diagonal, diagonal + NEAR, "right")
    for i, end in enumerate(ends.tolist()):
        total, forward, backward = np.zeros_like(bits[i]), {}, {}
        for j in sorted(range(i, end), key=lambda j: -size[j]):
            if _agree(pairs[j], forward, backward):
                total = total | bits[j]
                forward.update(pairs[j])
                backward.update((y, x) for x, y in pairs[j])
        covered = max(covered, int(np.bitwise_count(total).sum()))
    out = table.slice(0, 1).select(["doc", "copy", "item", "item_copy", "length"])
    return out.append_column("covered", pa.array([covered], pa.int32()))


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id") -> DataFrame:
    """One row per contaminated document and item: ``doc, copy, item, covered, length``.

    ``copy`` is a hash of the document's text, so (doc, copy) names it even if ids repeat."""
    spark = docs.sparkSession
    items = freeze_packed(only(benchmark, item=item_col, text=text_col)
                          .withColumn("item", F.col("item").cast("long")).distinct()
                          .mapInArrow(_items, _ITEM_ROWS), "benchmark-windows")
    # WINDOW, and the lengths of shorter items: a few numbers
    widths = sorted(r[0] for r in items.select(F.expr("length(slots) div 8")).distinct().collect())
    if not widths:
        widths = [WINDOW]
    bits = key_filter(items.select("key"))
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    found = freeze_packed(texts.mapInArrow(_documents(spark.sparkContext.broadcast(bits), widths), _DOC_ROWS)
                          .distinct(), "document-windows")
    theirs = items.select("item", F.col("copy").alias("item_copy"), "length", F.col("at").alias("item_at"),
                          "key", F.col("slots").alias("item_slots"), "real")
    matches = found.join(theirs, "key").filter("length(slots) = length(item_slots)") \
        .withColumn("diagonal", F.expr("at - item_at")).drop("key", "item_at")
    copies = matches.groupBy("doc", "copy", "item", "item_copy", "diagonal").applyInArrow(
        _copies, f"{_COPY}, diagonal int, bits binary, theirs binary, mine binary")
    return (copies.groupBy("doc", "copy", "item", "item_copy").applyInArrow(_joined, f"{_COPY}, covered int")
            .filter(f"covered >= {COVER} or 100 * covered >= {SHARE} * length")
            .groupBy("doc", "copy", "item").agg(F.max("covered").alias("covered"), F.max("length").alias("length")))


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                           text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per contaminated (document, item): ``id_col, item_col, n_covered, n_item``; a
    document that is there twice under one id and with one text is reported once."""
    return contaminations(docs, benchmark, id_col, text_col, item_col).select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col),
        F.col("covered").cast("long").alias("n_covered"), F.col("length").cast("long").alias("n_item")).distinct()


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id") -> DataFrame:
    """``docs`` without the contaminated documents, matched by id and whole text.

    Only ids and text hashes meet the join's other side; the texts pass it once."""
    bad = contaminations(docs, benchmark, id_col, text_col, item_col) \
        .select(F.col("doc").alias("__doc"), F.col("copy").alias("__copy")).distinct()

    def hashed(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            copies = [words.hashes(data, offsets[:-1], offsets[1:])
                      for _, _, data, offsets in words.slices(batch.column(at))]
            copy = np.concatenate(copies).view(np.int64) if copies else np.zeros(0, np.int64)
            yield batch.append_column("__own", pa.array(copy))
    keyed = docs.mapInArrow(hashed, T.StructType([*docs.schema.fields, T.StructField("__own", T.LongType())]))
    return keyed.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col("__doc"))
                      & (F.col("__own") == F.col("__copy")), "left_anti").drop("__own")
