"""Hard negatives by a GNAT-style multiway hyperplane tree.

A row's score for an anchor is the integer inner product of their quantised
vectors, floor(256 x) per component.  An anchor's positives are its best other
rows of its label; for each positive, its negatives are the best rows of other
labels whose score lies between 30 and 90 percent of the positive's.

*Scores as distances.*  Every row gets one more component that lifts it to the
length M of the longest row; anchors get 0 there.  Then the distance of anchor
and row is sqrt(|a|^2 + M^2 - 2 score): a window of scores is an annulus
around the anchor, and the best scores are the nearest rows.

*Tree.*  A node has up to ``DEGREE`` split points, chosen far apart from a
bounded sample of ``SAMPLE`` distinct rows (the only thing fitted on a sample);
a row belongs to the nearest one.  Every row is then dealt to its leaf, and
for each split point i and sibling j the least and greatest distance of i to
the rows below j are measured over *all* rows.  The tree has at most
``LEAVES`` leaves whatever the size of the table, so it is a small broadcast.

*Search.*  By the triangle inequality an anchor at distance d from split point
i is no nearer than max(d - high, low - d) and no farther than d + high to the
rows below j: siblings whose ranges miss the annulus (for positives: the ball
of the best so far) are eliminated, at every level of the path.  Leaves that
remain are searched exactly, row by row, and every anchor keeps its best.

*Spark.*  Rows lie in leaf order, cut by range on (leaf, row), so a hot leaf --
a vector that a third of all rows share -- spans tasks.  Anchors are the stated
query set: they come in blocks of at most ``ANCHORS``, broadcast one after the
other; a task gives at most its best few rows per anchor and window.

Defined results: rows with a null label, a null vector, or a component that is
null or not finite take no part; a vector that is shorter counts as having
zeros after it; a null id is no anchor and comes last among ties; equal rows
are rows of their own (an anchor isn't its own positive, its copy may be); no
anchors, no positives or an empty table give no rows; vectors so long that a
score could pass 2^53 are an error, as scores would not be exact.  Extra
columns are not read.  Jobs run while the plan is built.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import freeze, only, partitions

SCALE = 256
DEGREE = 8
SAMPLE = 8192          # rows that split points are chosen from
LEAVES = 256           # bound of the number of leaves (about)
LEAF_ROWS = 512        # rows of a leaf, while there are fewer leaves than that
ANCHORS = 8192         # anchors of one pass over the rows
CELLS = 1 << 20        # scores looked at together
NO_ID = np.iinfo(np.int64).max  # stands for a null id inside tasks
EXACT = 1 << 53


def matrix(column, dims: int) -> np.ndarray:
    """Arrow lists as rows of a matrix, padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.cumsum([0, *np.asarray(lists.value_lengths())]) if len(lists) else np.zeros(1, np.int64)
    flat = np.asarray(lists.flatten(), np.float64)
    size = np.diff(ends)
    out = np.zeros((len(size), dims))
    out[np.arange(dims) < size[:, None]] = flat
    return out


class Tree:
    """Split points of all nodes, side by side, and the path of every leaf.

    ``paths[leaf]`` is the list of (first point of the node, number of its points, branch)."""

    def __init__(self, sample: np.ndarray, length: float, leaf_share: float, degree: int = DEGREE):
        self.length, self.degree = length, degree      # M^2
        self.points, self.nodes, self.paths = [], [], []
        distinct = np.unique(sample, axis=0) if sample.size else sample
        self._split(distinct, max(2 * degree, int(leaf_share * len(sample))), [])
        dims = sample.shape[1]
        self.points = np.concatenate(self.points) if self.points else np.zeros((0, dims))
        self.lifted = self._lift(self.points)

    def _lift(self, x):
        return np.sqrt(np.maximum(self.length - (x * x).sum(axis=1), 0))

    def distances(self, x, points, lifted, lift) -> np.ndarray:
        """Of rows (``lift`` their last component) to split points."""
        square = (x * x).sum(axis=1) + lift * lift
        return np.sqrt(np.maximum(square[:, None] + self.length - 2 * (x @ points.T + np.outer(lift, lifted)), 0))

    def _split(self, x, least, path) -> int:
        """Builds the node over these rows; its number, or minus its leaf's number minus 1."""
        if len(x) <= least:
            self.paths.append(path)
            return -len(self.paths)
        lift = self._lift(x)
        far, chosen = np.full(len(x), np.inf), [int(np.argmax(lift))]
        while len(chosen) < self.degree:  # each point is the farthest from those before
            at = chosen[-1]
            far = np.minimum(far, self.distances(x, x[at:at + 1], lift[at:at + 1], lift)[:, 0])
            far[at] = -1
            chosen.append(int(np.argmax(far)))
        points = x[chosen]
        first = sum(map(len, self.points))
        self.points.append(points)
        node = len(self.nodes)
        self.nodes.append(None)
        branch = np.argmin(self.distances(x, points, lift[chosen], lift), axis=1)
        self.nodes[node] = (first, [self._split(x[branch == j], least, [*path, (first, len(points), j)])
                                    for j in range(len(points))])
        return node

    def assign(self, x: np.ndarray):
        """The leaf of each row, and what was seen on the way: (point, branch, distances)."""
        lift, leaf, seen = self._lift(x), np.zeros(len(x), np.int32), []
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            node, rows = todo.pop()
            first, children = self.nodes[node]
            at = slice(first, first + len(children))
            d = self.distances(x[rows], self.points[at], self.lifted[at], lift[rows])
            branch = np.argmin(d, axis=1)
            for j, child in enumerate(children):
                below = branch == j
                if not below.any():
                    continue
                part = d[below]
                seen += [(first + i, j, part[:, i].min(), part[:, i].max()) for i in range(len(children))]
                if child < 0:
                    leaf[rows[below]] = -child - 1
                else:
                    todo.append((child, rows[below]))
        return leaf, seen


def _assign(tree, dims: int):
    """mapInArrow: rows -> rows with their leaf, and the task's distance ranges (null leaf)."""
    def run(batches):
        low, high = {}, {}
        for batch in batches:
            leaf, seen = tree.value.assign(matrix(batch.column("q"), dims))
            for point, branch, least, most in seen:
                k = point, branch
                low[k], high[k] = min(low.get(k, least), least), max(high.get(k, most), most)
            n = len(leaf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf), *[batch.column(c) for c in ("row", "vec", "label", "q")],
                 *[pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.float64(), pa.float64())]],
                ["leaf", "row", "vec", "label", "q", "point", "branch", "low", "high"])
        if low:
            n = len(low)
            point, branch = zip(*low, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.list_(pa.int64())), pa.array(point, pa.int32()), pa.array(branch, pa.int32()),
                 pa.array([float(low[k]) for k in low]), pa.array([float(high[k]) for k in low])],
                ["leaf", "row", "vec", "label", "q", "point", "branch", "low", "high"])
    return run


class Search:
    """Anchors of one block against the tree: per leaf the bounds of each anchor's distance."""

    def __init__(self, tree: Tree, low: np.ndarray, high: np.ndarray, q: np.ndarray):
        self.tree, self.low, self.high = tree, low, high
        self.square = (q * q).sum(axis=1)
        self.d = tree.distances(q, tree.points, tree.lifted, np.zeros(len(q))) if len(tree.points) else \
            np.zeros((len(q), 0))
        self.slack = 1e-6 * np.sqrt(tree.length + 1)  # far above the rounding of distances

    def bounds(self, leaf: int):
        """``(least, most)`` distance of each anchor to the leaf's rows."""
        least, most = np.zeros(len(self.d)), np.full(len(self.d), np.inf)
        for first, n, j in self.tree.paths[leaf] if self.tree.paths else []:
            d, low, high = self.d[:, first:first + n], self.low[first:first + n, j], self.high[first:first + n, j]
            least = np.maximum(least, np.maximum(d - high, low - d).max(axis=1))
            most = np.minimum(most, (d + high).min(axis=1))
        return least - self.slack, most + self.slack

    def scores(self, leaf: int):
        """``(least, most)`` score that a row of the leaf can have with each anchor."""
        near, far = self.bounds(leaf)
        base = self.square + self.tree.length
        return (base - far * far) / 2, (base - np.maximum(near, 0) ** 2) / 2


class Best:
    """The best k rows of each slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), -np.inf)
        self.id = np.full((slots, k), NO_ID)
        self.row = np.full((slots, k), NO_ID)

    def worst(self):
        return self.score[:, -1]

    def add(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores (slots x rows, -inf: not wanted) of rows in ascending order of id."""
        if score.shape[1] > self.k:
            floor = np.partition(score, -self.k, axis=1)[:, -self.k]
            floor = np.maximum(floor, self.worst()[slots])[:, None]
            same = (score == floor) & (score > -np.inf)
            hit = (score > floor) | (same & (np.cumsum(same, axis=1) <= self.k))
        else:
            hit = (score > -np.inf) & (score >= self.worst()[slots][:, None])
        s, j = np.nonzero(hit)
        if not len(s):
            return
        touched = slots[np.unique(s)]
        old = self.score[touched] > -np.inf
        slot = np.r_[slots[s], np.repeat(touched, old.sum(axis=1))]
        value = np.r_[score[s, j], self.score[touched][old]]
        ident, row = np.r_[ids[j], self.id[touched][old]], np.r_[rows[j], self.row[touched][old]]
        order = np.lexsort((row, ident, -value, slot))
        slot, value, ident, row = slot[order], value[order], ident[order], row[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        top = rank < self.k
        self.score[slot[top], rank[top]] = value[top]
        self.id[slot[top], rank[top]] = ident[top]
        self.row[slot[top], rank[top]] = row[top]

    def batch(self, names: list[np.ndarray]) -> pa.RecordBatch:
        s, r = np.nonzero(self.score > -np.inf)
        ids = self.id[s, r]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(x[s]) for x in names], pa.array(self.score[s, r].astype(np.int64)),
             pa.array(ids, mask=ids == NO_ID), pa.array(self.row[s, r])],
            [f"k{i}" for i in range(len(names))] + ["score", "vec", "row"])


def _leaf_runs(batches, dims: int):
    """``(leaf, labels, ids, rows, vectors)`` of runs of one leaf, ids ascending."""
    for batch in batches:
        leaf = batch.column("leaf").to_numpy()
        vec = batch.column("vec").fill_null(NO_ID).to_numpy()
        q, row, label = matrix(batch.column("q"), dims), batch.column("row").to_numpy(), batch.column("label").to_numpy()
        for x in np.unique(leaf):
            at = np.flatnonzero(leaf == x)
            at = at[np.lexsort((row[at], vec[at]))]
            yield int(x), label[at], vec[at], row[at], q[at]


def _positives(block, dims: int, k: int):
    """mapInArrow: the task's best other rows of each anchor's label."""
    def run(batches):
        b = block.value
        search, best = Search(b["tree"], b["low"], b["high"], b["q"]), Best(len(b["row"]), k)
        for leaf, label, ids, rows, q in _leaf_runs(batches, dims):
            _, most = search.scores(leaf)
            want = most >= best.worst()
            for x in np.unique(label):
                anchors, mine = np.flatnonzero(want & (b["label"] == x)), np.flatnonzero(label == x)
                step = max(1, CELLS // len(mine))
                for lo in range(0, len(anchors), step):
                    some = anchors[lo:lo + step]
                    score = b["q"][some] @ q[mine].T
                    score[b["row"][some][:, None] == rows[mine]] = -np.inf
                    best.add(some, score, ids[mine], rows[mine])
        yield best.batch([b["row"]])
    return run


def _negatives(block, dims: int, k: int):
    """mapInArrow: the task's best rows of other labels in each anchor's windows."""
    def run(batches):
        b = block.value
        owner, low, high = b["owner"], b["least"], b["most"]  # of each window
        search, best = Search(b["tree"], b["low"], b["high"], b["q"]), Best(len(owner), k)
        for leaf, label, ids, rows, q in _leaf_runs(batches, dims):
            least, most = search.scores(leaf)
            want = (most[owner] >= np.maximum(low, best.worst())) & (least[owner] <= high)
            windows = np.flatnonzero(want)
            step = max(1, CELLS // len(rows))
            for lo in range(0, len(windows), step):
                w = windows[lo:lo + step]
                anchors, place = np.unique(owner[w], return_inverse=True)
                score = (b["q"][anchors] @ q.T)
                score[b["label"][anchors][:, None] == label] = -np.inf
                score = score[place]
                score[(score < low[w][:, None]) | (score > high[w][:, None])] = -np.inf
                best.add(w, score, ids, rows)
        yield best.batch([b["row"][owner], b["positive"]])
    return run


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec").asc_nulls_last(), "row")
    return df.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def quantised(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """``row, vec, label, q``: the rows that take part, numbered, in whole numbers."""
    rows = only(df, vec=id_col, label=label_col, v=vector_col).selectExpr(
        "cast(vec as bigint) as vec", "cast(label as bigint) as label", "v").filter(
        "label is not null and v is not null and forall(v, x -> x is not null and not isnan(x) "
        "and abs(x) < double('infinity'))")
    q = F.expr(f"transform(v, x -> cast(floor(cast({scale} as double) * cast(x as double)) as bigint))")
    return freeze(rows.select(F.monotonically_increasing_id().alias("row"), "vec", "label", q.alias("q")), "gnat-rows")


def build(rows: DataFrame, leaf_rows: int = LEAF_ROWS, sample: int = SAMPLE, leaves: int = LEAVES):
    """``(rows in leaf order, tree, low, high, dims)`` of quantised rows."""
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)), F.max(F.size("q")),
                    F.max(F.expr("aggregate(q, 0D, (s, x) -> s + cast(x as double) * x)"))).first()
    n, dims, square = size[0], size[1] or 0, size[2] or 0.0
    if square >= EXACT:
        raise ValueError("vectors too long: scores would not be exact")
    chosen = rows.select("q").orderBy(F.xxhash64("row"), "row").limit(sample).toArrow()
    tree = Tree(matrix(chosen.column("q"), dims), square, max(leaf_rows / max(n, 1), 1 / leaves))
    shared = spark.sparkContext.broadcast(tree)
    schema = ("leaf int, row long, vec long, label long, q array<bigint>, "
              "point int, branch int, low double, high double")
    dealt = freeze(rows.mapInArrow(_assign(shared, dims), schema), "gnat-leaves")
    low, high = np.full((len(tree.points), DEGREE), np.inf), np.full((len(tree.points), DEGREE), -np.inf)
    ranges = dealt.filter("leaf is null").groupBy("point", "branch").agg(F.min("low"), F.max("high"))
    for point, branch, least, most in ranges.collect():  # split points x degree, bounded by LEAVES
        low[point, branch], high[point, branch] = least, most
    ordered = (dealt.filter("leaf is not null").select("leaf", "row", "vec", "label", "q")
               .repartitionByRange(partitions(rows), "leaf", "row").sortWithinPartitions("leaf", "row"))
    return freeze(ordered, "gnat-ordered"), tree, low, high, dims


def mine(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         anchor_step: int = 100, positives: int = 5, negatives: int = 10, low_pct: int = 30, high_pct: int = 90,
         block_rows: int = ANCHORS, **tree_options) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``anchor_step``."""
    spark = df.sparkSession
    rows = quantised(df, id_col, vector_col, label_col)
    ordered, tree, low, high, dims = build(rows, **tree_options)
    anchors = rows.filter(F.col("vec") % anchor_step == 0)
    blocks = max(1, -(-2 * anchors.count() // block_rows))
    anchors = freeze(anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "gnat-anchors")
    best, found = [], []
    for number in range(blocks):  # about block_rows / 2 anchors on the driver at a time
        mine_ = anchors.filter(F.col("block") == number).orderBy("row").toArrow()
        block = {"tree": tree, "low": low, "high": high, "q": matrix(mine_.column("q"), dims),
                 "row": mine_.column("row").to_numpy(), "label": mine_.column("label").to_numpy()}
        shared = spark.sparkContext.broadcast(block)
        got = ordered.mapInArrow(_positives(shared, dims, positives), "k0 long, score long, vec long, row long")
        got = freeze(_first(got, ["k0"], positives), "gnat-positives")
        best.append(got)
        pos = got.select("k0", "row", "score").toArrow()  # at most positives per anchor
        score = pos.column("score").to_numpy()
        windows = {"owner": np.searchsorted(block["row"], pos.column("k0").to_numpy()),
                   "positive": pos.column("row").to_numpy(),
                   "least": -(-low_pct * score // 100), "most": high_pct * score // 100}
        shared = spark.sparkContext.broadcast(block | windows)
        got = ordered.mapInArrow(_negatives(shared, dims, negatives),
                                 "k0 long, k1 long, score long, vec long, row long")
        found.append(freeze(_first(got, ["k0", "k1"], negatives), "gnat-negatives"))
    names = anchors.select(F.col("row").alias("k0"), F.col("vec").alias("anchor_id"))
    positive, negative = best[0], found[0]
    for x, y in zip(best[1:], found[1:], strict=True):
        positive, negative = positive.union(x), negative.union(y)
    positive = positive.select("k0", F.col("row").alias("k1"), F.col("vec").alias("positive_id"),
                               F.col("score").alias("positive_score"))
    return (negative.select("k0", "k1", "rank", F.col("vec").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(positive, ["k0", "k1"]).join(names, "k0")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
