"""Secrets: three fixed patterns, and strings that look random to two character models.

Base patterns (leftmost, not overlapping within a kind): assignments to words
like ``password``, access keys, and long hexadecimal runs.

The method adds the other runs of ``[A-Za-z0-9+/_.=-]`` of 12 or more characters with a
letter (numbers, dates and addresses of digits alone are no identifiers) whose log-likelihood ratio between a model of *random strings* and a model of
*ordinary identifiers* is high.  Both are interpolated second-order Markov models
over the 68 characters; the random one is mixed half and half with uniform
characters, so that random strings of another alphabet than the samples' pass.

Their labelled samples come from the whole corpus: the strings that a base pattern
calls secret, and all runs that touch none.  Every distinct string counts once and
every count is lowered by one, so a secret that no pattern names doesn't teach the
ordinary model itself, however often it was copied.  The threshold is chosen over the
same distinct strings: midway between the ``HIGH`` quantile of the ordinary scores below
0 (where the ordinary model is the likelier one, so unnamed secrets among the runs
don't move it, however many) and the ``LOW`` quantile of the random ones, and never below 0.

One pass reads the texts; runs and base spans are kept per document and the
rest works on those.  The counts (69^3 per model) and a histogram of the scores are what
reaches the driver.

Defined cases: a null or empty text has no spans; repeated ids and rows are judged
row by row; without base hits (or without ordinary runs) there is nothing to
learn from and only base spans are given; offsets are code points of the whole
text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import freeze_packed, only
from ledgerlift.llm.counting import count_table

# Fixed patterns and smallest lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
RUN = r"[A-Za-z0-9+/_.=-]+"
LEAST = {"assign": 12, "access": 18, "hex": 16, "run": 12}
LETTER = re.compile("[A-Za-z]")
KEYWORDS = ("pass", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CODES = len(ALPHABET) + 1            # 0 stands before the first character
WEIGHT = 8.0                         # of the next lower order in the interpolation
UNIFORM = 0.5                        # share of uniform characters in the random model
SCALE = 1 << 16
BINS = 4096
LIMIT = 16.0
LOW, HIGH = 0.05, 0.99

SPAN = "array<struct<kind:int,start:int,end:int>>"
FOUND = f"doc long, base {SPAN}, secret array<string>, runs array<struct<start:int,end:int,value:string>>"


def base_spans(text: str, assign, access, hexes, run) -> tuple[list, list, list]:
    """Base spans, their secret strings, and the long runs that touch none of them."""
    spans, secret, runs = [], [], []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        for m in assign.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                spans.append((m.start(), 0, m.end()))
                secret.append(m[2])
    for m in run.finditer(text):
        value, at = m[0], m.start()
        for kind, pattern in ((1, access), (2, hexes)):
            for x in pattern.finditer(value):
                if x.end() - x.start() >= LEAST[KINDS[kind]]:
                    spans.append((at + x.start(), kind, at + x.end()))
                    secret.append(x[0])
        if LETTER.search(value):
            runs.append((at, m.end(), value))
    if spans:
        spans.sort()
        # of the spans that start before a run ends, the furthest end tells whether one touches it
        starts = [start for start, _, _ in spans]
        furthest = list(accumulate((end for _, _, end in spans), max))
        runs = [r for r in runs if not (n := bisect_left(starts, r[1])) or furthest[n - 1] <= r[0]]
    return spans, secret, runs


def _scan(batches):
    """mapInArrow: (doc, text) -> base spans, secret strings and runs of each document."""
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    access, hexes = re.compile(ACCESS), re.compile(HEX)
    run = re.compile(RUN[:-1] + "{%d,}" % LEAST["run"])
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    value = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])
    for batch in batches:
        for lo in range(0, len(batch), 1000):
            part = batch.slice(lo, 1000)
            found = [base_spans(t or "", assign, access, hexes, run) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc": part.column(0),
                "base": pa.array([[{"kind": k, "start": s, "end": e} for s, k, e in x[0]] for x in found],
                                 pa.list_(kind)),
                "secret": pa.array([x[1] for x in found], pa.list_(pa.string())),
                "runs": pa.array([[{"start": s, "end": e, "value": v} for s, e, v in x[2]] for x in found],
                                 pa.list_(value))})


_CODE = np.zeros(256, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i + 1


def contexts(values: pa.Array):
    """``(index into the count table, string of each character)`` for ASCII strings."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    # strings without a small letter are read as small letters: capitals alone aren't random
    small = pc.match_substring_regex(values, "[a-z]")
    values = pc.if_else(small, values, pc.ascii_lower(values))
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    code = _CODE[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    one, two = np.r_[0, code[:-1]], np.r_[0, 0, code[:-2]] if len(code) > 1 else np.zeros(1, np.int64)
    begin = offsets[:-1][np.diff(offsets) > 0]
    one[begin], two[begin] = 0, 0
    after = begin[begin + 1 < len(code)] + 1
    two[after] = 0
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return (two * CODES + one) * CODES + code, row, offsets


def _count(batches) -> np.ndarray:
    """Count tables of random and ordinary strings over (random, value) rows."""
    total = np.zeros((2, CODES ** 3), np.int64)
    for batch in batches:
        for k in (0, 1):
            chosen = batch.column(1).filter(pc.equal(batch.column(0), k))
            total[k] += np.bincount(contexts(chosen)[0], minlength=CODES ** 3)
    return total.ravel()


def model(counts: np.ndarray) -> np.ndarray:
    """P(character | two before), interpolated with the shorter contexts."""
    three = np.maximum(counts - 1, 0).reshape(CODES, CODES, CODES).astype(float)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + CODES)
    p2 = (two + WEIGHT * p1) / (two.sum(axis=1, keepdims=True) + WEIGHT)
    p3 = (three + WEIGHT * p2) / (three.sum(axis=2, keepdims=True) + WEIGHT)
    return p3.ravel()


def samples(found: DataFrame) -> DataFrame:
    """The distinct (kind, value) strings: 0 secrets of base patterns, 1 runs."""
    return found.select(F.lit(0).alias("kind"), F.explode("secret").alias("value")).union(
        found.select(F.lit(1), F.explode("runs.value"))).distinct()


def learn(found: DataFrame) -> np.ndarray | None:
    """Integer log ratios for each character after each two; None without samples of both kinds."""
    secret, plain = count_table(samples(found), _count, 2 * CODES ** 3).reshape(2, -1)
    if not secret.any() or not plain.any():
        return None
    random = UNIFORM / CODES + (1 - UNIFORM) * model(secret)
    return np.rint((np.log(random) - np.log(model(plain))) * SCALE).astype(np.int64)


def scores(values: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio per character of each string."""
    index, row, offsets = contexts(values)
    total = np.bincount(row, weights=weights[index], minlength=len(values))  # exact: integers below 2^53
    return total / SCALE / np.maximum(np.diff(offsets), 1)


def _bins(weights: np.ndarray):
    def run(batches):
        total = np.zeros((2, BINS), np.int64)
        for batch in batches:
            for k in (0, 1):
                values = batch.column(1).filter(pc.equal(batch.column(0), k))
                if len(values):
                    at = np.floor((scores(values, weights) + LIMIT) * BINS / (2 * LIMIT))
                    total[k] += np.bincount(np.clip(at, 0, BINS - 1).astype(np.int64), minlength=BINS)
        k, at = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(k, pa.int32()), "bin": pa.array(at, pa.int32()),
                                          "n": pa.array(total[k, at])})
    return run


def choose_cut(found: DataFrame, weights: np.ndarray) -> float:
    """The score from which a run is a secret (see the module's text)."""
    rows = (samples(found).mapInArrow(_bins(weights), "kind int, bin int, n long")
            .groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect())  # at most 2 * BINS rows
    total = np.zeros((2, BINS), np.int64)
    for r in rows:
        total[r["kind"], r["bin"]] += r["n"]
    total[1, BINS // 2:] = 0  # runs that score 0 or more
    secret, plain = (np.cumsum(t) / max(t.sum(), 1) for t in total)
    low, high = np.searchsorted(secret, LOW), np.searchsorted(plain, HIGH)
    return max(0.0, float((low + high + 1) / 2 * 2 * LIMIT / BINS - LIMIT))


def _judge(weights: np.ndarray | None, cut: float):
    """mapInArrow: found -> (doc, base spans, all spans)."""
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            runs = batch.column("runs")
            flat, sizes = runs.flatten(), np.diff(runs.offsets.to_numpy())
            picked: list[list] = [[] for _ in range(len(batch))]
            if weights is not None and len(flat):
                row = np.repeat(np.arange(len(batch)), sizes)
                for i in np.flatnonzero(scores(flat.field("value"), weights) >= cut):
                    picked[row[i]].append({"kind": 3, "start": flat[i]["start"].as_py(), "end": flat[i]["end"].as_py()})
            base = batch.column("base").to_pylist()
            spans = [sorted(b + p, key=lambda x: (x["start"], x["kind"])) if p else b
                     for b, p in zip(base, picked, strict=True)]
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc"), "base": batch.column("base"),
                                              "spans": pa.array(spans, pa.list_(kind))})
    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, base, spans``: arrays of (kind, start, end); kind indexes ``KINDS``."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    found = freeze_packed(texts.mapInArrow(_scan, FOUND), "secret-runs")
    weights = learn(found)
    cut = 0.0 if weights is None else choose_cut(found, weights)
    return found.mapInArrow(_judge(weights, cut), f"doc long, base {SPAN}, spans {SPAN}") \
        .withColumnRenamed("doc", id_col)


def spans_text(column: str):
    """``kind:start:end`` of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({column}, x -> concat(array({names})[x.kind], ':', "
                  "x.start, ':', x.end)), ',')")


def with_digests(found: DataFrame) -> DataFrame:
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {i})) as long)").alias(f"n_{k}")
              for i, k in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts,
                        F.sha2(spans_text("base").cast("binary"), 256).alias("base_sha256"),
                        spans_text("spans").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark`` (overlapping spans by one), and
    ``n_chars``, if there is such a column, counted anew.

    The learnt models are the same as in :func:`find_secrets`; texts are scanned
    again where they lie, so nothing is joined by id.
    """
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    found = freeze_packed(texts.mapInArrow(_scan, FOUND), "secret-runs")
    weights = learn(found)
    cut = 0.0 if weights is None else choose_cut(found, weights)

    def clean(batches):
        assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        access, hexes = re.compile(ACCESS), re.compile(HEX)
        run = re.compile(RUN[:-1] + "{%d,}" % LEAST["run"])
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            out = []
            for text in batch.column(at).to_pylist():
                if text:
                    spans, _, runs = base_spans(text, assign, access, hexes, run)
                    spans = [(s, e) for s, _, e in spans]
                    if weights is not None and runs:
                        high = scores(pa.array([r[2] for r in runs]), weights) >= cut
                        spans += [r[:2] for r, h in zip(runs, high, strict=True) if h]
                    if spans:
                        parts, done = [], 0
                        for s, e in sorted(spans):
                            if s >= done:
                                parts += [text[done:s], mark]
                            done = max(done, e)
                        text = "".join([*parts, text[done:]])
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
    cleaned = docs.mapInArrow(clean, docs.schema)
    return cleaned.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else cleaned
