"""Source divergence audit over the terms that iceberg prefix refinement keeps.

A language keeps the terms that stand in at least ``MIN_DOCS`` of its documents.

*Iceberg prefix refinement.*  A prefix of a term stands in at least as many
documents as the term.  So prefixes are counted level by level (3, 6, 12, 24,
... bytes): the distinct documents of each (language, prefix) are summed, the
prefixes below the threshold go, and only extensions of the others are counted
at the next level.  A term that ends within a level's bytes is complete there;
complete terms that pass are the kept terms.  A rare term, however long, is
never counted beyond its first rare prefix.

*What moves.*  Texts are gathered by (language, source) once, in pieces of
about equal size, and cut into terms.  Each task adds up its documents' counts, some MB of text at once
-- documents by (level, language, prefix), occurrences by (language, source,
term) -- and writes those rows to the shared folder; the levels and the final
counts are joins and sums over that table.  No row of it is a text or a
document, and nothing of the vocabulary reaches the driver.

*Divergence.*  With count occurrences of a kept term in a group, N the group's
sum and V the language's kept terms, p = 1 + floor(10^9 (count + 2) / (N + 2V));
f(p, q) = floor((p - q)^2 / (p + q)).  Pairs of sources sum f over all kept
terms: terms are dealt into buckets, a bucket adds up f over its terms for
tiles of sources (terms that neither source has all give one f, counted by
number), and the sums are added per pair.

Defined results: null text, language and source are ''; a group without kept
terms has N = 0; a language without kept terms gives pairs of value 0 and no
term rows; repeated rows are documents of their own; very long terms are
counted like others; an empty table gives no rows; extra columns are not read.
Jobs run while the plan is built (one per level).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm import words
from ledgerlift.llm.common import freeze, freeze_packed, only

MIN_DOCS = 10
FIRST_LEVEL = 3        # bytes of the first level's prefixes; each level doubles them
TOP = 10
SCALE = 1_000_000_000
FLUSH = 8 << 20        # bytes of text whose counts a task holds before it writes them (one longer text by itself)
ROWS = 1 << 15         # rows of one output batch
TILE = 64              # sources compared with all others at a time
BUCKET_CELLS = 1 << 17

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True
OCCURRENCES = -1
_SCHEMA = "level int, lang string, source string, term binary, complete boolean, n long"
_ARROW = pa.schema([("level", pa.int32()), ("lang", pa.string()), ("source", pa.string()),
                    ("term", pa.binary()), ("complete", pa.bool_()), ("n", pa.int64())])


def level_bytes(level: int) -> int:
    return FIRST_LEVEL << level


def _runs(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the terms, and the row of each."""
    solid = LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    finishes[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _pairs(a: np.ndarray, b: np.ndarray):
    """Distinct pairs of two id arrays with their numbers."""
    width = int(b.max()) + 1 if len(b) else 1
    both, n = np.unique(a * width + b, return_counts=True)
    return both // width, both % width, n


def _slice_counts(data, offsets, lang, group):
    """Counts of one slice of rows: ``(level, language or group, term bytes, complete, n)`` arrays.

    ``lang`` and ``group`` number each row's language and (language, source)."""
    starts, ends, row = _runs(data, offsets)
    if not len(starts):
        return
    data = words.LOWER[data]
    text = data.tobytes()
    _, first, term = np.unique(words.hashes(data, starts, ends), return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]  # of each distinct term
    spelled = pa.array([text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())
    g, t, n = _pairs(group[row], term)
    yield OCCURRENCES, g, spelled.take(pa.array(t)), np.ones(len(t), bool), n
    doc, t, _ = _pairs(row, term)  # each term of a document once
    level = 0
    while len(t):
        size = level_bytes(level)
        cut = np.minimum(ends, starts + size)
        key = words.hashes(data, starts, cut) ^ words.odd(2) * (ends - starts <= size).astype(np.uint64)
        _, example, prefix = np.unique(key, return_index=True, return_inverse=True)
        held, p, _ = _pairs(doc, prefix[t])  # each prefix of a document once
        g, p, n = _pairs(lang[held], p)
        whole = (ends - starts <= size)[example]
        yield level, g, pc.binary_slice(spelled.take(pa.array(example)), 0, size).take(pa.array(p)), whole[p], n
        longer = (ends - starts > size)[t]
        doc, t, level = doc[longer], t[longer], level + 1


def _count_terms(batches):
    """mapInArrow: (text, lang, source) -> counts of each slice of rows, added up by arrays."""
    for batch in batches:
        langs, sources = (pc.fill_null(batch.column(c), "").to_pylist() for c in (1, 2))
        for lo, hi, data, offsets in words.slices(batch.column(0), FLUSH):
            group = {g: i for i, g in enumerate(dict.fromkeys(zip(langs[lo:hi], sources[lo:hi], strict=True)))}
            lang = {x: i for i, x in enumerate(dict.fromkeys(langs[lo:hi]))}
            group_of = np.array([group[g] for g in zip(langs[lo:hi], sources[lo:hi], strict=True)], np.int64)
            lang_of = np.array([lang[x] for x in langs[lo:hi]], np.int64)
            of_group, names = [pa.array(x, pa.string()) for x in zip(*group, strict=True)], pa.array(list(lang), pa.string())
            for level, of, terms, complete, n in _slice_counts(data, offsets, lang_of, group_of):
                at = pa.array(of)
                lang_source = [x.take(at) for x in of_group] if level == OCCURRENCES else \
                    [names.take(at), pa.nulls(len(of), pa.string())]
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(of), level, np.int32)), *lang_source, terms, pa.array(complete), pa.array(n)],
                    schema=_ARROW)
                for k in range(0, len(rows), ROWS):
                    yield rows.slice(k, ROWS)


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term`` (binary): the terms of at least ``min_docs`` documents, level by level."""
    last = counts.agg(F.max("level")).first()[0]
    kept, alive = None, None
    for level in range((-1 if last is None else last) + 1):
        rows = counts.filter(F.col("level") == level).select("lang", "term", "complete", "n")
        if alive is not None:
            # only extensions of prefixes that passed
            rows = (rows.withColumn("parent", F.expr(f"substring(term, 1, {level_bytes(level - 1)})"))
                    .join(alive, ["lang", "parent"], "left_semi"))
        passed = freeze(rows.groupBy("lang", "term", "complete").agg(F.sum("n").alias("docs"))
                        .filter(F.col("docs") >= min_docs).select("lang", "term", "complete"), "iceberg-level")
        complete = passed.filter("complete").select("lang", "term")
        kept = complete if kept is None else kept.union(complete)
        alive = passed.filter("not complete").select("lang", F.col("term").alias("parent"))
    return kept if kept is not None else counts.select("lang", "term").limit(0)


def _share(count: str) -> str:
    """p of a count, in exact decimals (``n`` and ``v`` of the group)."""
    return (f"1 + cast((cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(19,0))) "
            f"div cast(n + 2 * v as decimal(20,0)) as bigint)")


def _gap(p, q):
    return (p - q) * (p - q) // (p + q)


def _tile_sums(table: pa.Table, groups: pa.Table) -> pa.Table:
    """cogroup, one bucket of one language's terms: per pair of sources (each pair once) the sum
    of f over the terms that either has, and the number of those terms."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()),
                        ("value", pa.int64()), ("terms", pa.int64())])
    if not table.num_rows or groups.num_rows < 2:
        return schema.empty_table()
    groups = groups.sort_by("source")
    names, lang = groups.column("source"), groups.column("lang")[0].as_py()
    term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    at = pc.index_in(table.column("source"), names).to_numpy()
    p = np.repeat(groups.column("p0").to_numpy()[:, None], int(term.max()) + 1, axis=1)
    has = np.zeros(p.shape, bool)
    p[at, term], has[at, term] = table.column("p").to_numpy(), True
    there, place, out = has.any(axis=1), np.arange(len(has)), []
    for i in np.flatnonzero(there):  # a source that has a term here, with every other
        for lo in range(0, len(has), TILE):
            j = place[lo:lo + TILE]
            j = j[(j != i) & ~(there[j] & (j < i))]  # two such sources meet once
            either = has[j] | has[i]  # terms of neither are counted afterwards
            value = np.where(either, _gap(p[j], p[i]), 0).sum(axis=1)
            out.append((np.minimum(i, j), np.maximum(i, j), value, either.sum(axis=1)))
    i, j, value, number = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table([pa.array([lang] * len(i), pa.string()), names.take(pa.array(i)), names.take(pa.array(j)),
                     pa.array(value), pa.array(number)], schema=schema)


def _grouped(texts: DataFrame, counts: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lang, source, term, count`` of kept terms, and ``lang, source, n, v, p0`` of every group."""
    cells = freeze(counts.filter(F.col("level") == OCCURRENCES).join(kept, ["lang", "term"], "left_semi")
                   .groupBy("lang", "source", "term").agg(F.sum("n").alias("count")), "iceberg-cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = texts.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = (groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
              .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")))
    return cells, freeze(groups.selectExpr("*", f"case when v > 0 then {_share('0')} end as p0"), "iceberg-groups")


def pair_buckets(groups: DataFrame) -> int:
    """Buckets of a language's terms: a bucket's work is bounded by its cells, and each bucket
    gives a row per pair of sources, so there are no more than the cells ask for."""
    cells = groups.agg(F.coalesce(F.sum("v"), F.lit(0))).first()[0]
    return max(1, -(-cells // BUCKET_CELLS))


def _pair_part(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with its divergence."""
    buckets = pair_buckets(groups)
    dealt = shares.select("lang", "source", "term", "p",
                          F.expr(f"pmod(xxhash64(term), {buckets}L)").alias("bucket"))
    # both sides' buckets are bigint: a cogroup doesn't cast its keys, and an int hashes to another partition
    sides = groups.filter("v > 0").selectExpr("lang", "source", "p0", f"explode(sequence(0L, {buckets - 1}L)) as bucket")
    sums = (dealt.groupBy("lang", "bucket").cogroup(sides.groupBy("lang", "bucket"))
            .applyInArrow(_tile_sums, "lang string, source string, item string, value long, terms long"))
    sums = (sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
            .selectExpr("lang", "value", "terms", "explode(array(struct(source, item), "
                        "struct(item as source, source as item))) as pair")
            .select("lang", "pair.source", "pair.item", "value", "terms"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = groups.join(other, "lang").filter("source <> item").join(sums, ["lang", "source", "item"], "left")
    # kept terms that neither source has: one value, as often as there are such terms
    rest = "(v - coalesce(terms, 0)) * (((p0 - q0) * (p0 - q0)) div (p0 + q0))"
    return pairs.selectExpr("lang", "source", "'pair' as part", "item",
                            f"coalesce(value, 0) + case when v > 0 then {rest} else 0 end as value")


def _term_part(cells: DataFrame, shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Kept terms that a group has more often than its language."""
    whole = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.max("v").alias("v"))
    common = (cells.groupBy("lang", "term").agg(F.sum("count").alias("count")).join(whole, "lang")
              .selectExpr("lang", "term", f"{_share('count')} as q"))
    return (shares.join(common, ["lang", "term"]).filter("p > q")
            .selectExpr("lang", "source", "'term' as part", "cast(term as string) as item",
                        "((p - q) * (p - q)) div (p + q) as value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergences of sources (part ``pair``, all of
    them) and the terms that set a source apart from its language (part ``term``, ``top`` each)."""
    texts = only(docs, text=text_col, lang=lang_col, source=source_col)
    # texts of one group go to as few tasks as their size allows (AQE splits large groups):
    # a task then meets the same terms again and again, and its sums are few
    gathered = texts.hint("rebalance", "lang", "source")
    counts = freeze_packed(gathered.mapInArrow(_count_terms, _SCHEMA), "iceberg-counts")
    kept = freeze(kept_terms(counts, min_docs), "iceberg-kept")
    cells, groups = _grouped(texts, counts, kept)
    shares = cells.join(groups, ["lang", "source"]).selectExpr(
        "lang", "source", "term", f"{_share('count')} as p")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = F.row_number().over(order).cast("int")
    pairs = _pair_part(shares, groups).withColumn("rank", ranked)
    terms = _term_part(cells, shares, groups).withColumn("rank", ranked).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)
