"""Connected components of a distributed link table (no links on the driver)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import drop_frozen, freeze

FEW_LINKS = 1 << 18  # links that one task joins up by itself (4 MB of ids)


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.expr("array(struct(a, b), struct(b as a, a as b))")).alias("e")) \
        .select("e.a", "e.b")


def _are_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one other, and none of those hangs on a further one."""
    ends = links.selectExpr("a as node", "1 as hangs", "0 as holds") \
        .union(links.selectExpr("b as node", "0 as hangs", "1 as holds"))
    wrong = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")) \
        .filter("hangs > 1 or (hangs = 1 and holds = 1)")
    return wrong.count() == 0


def _joined(batches):
    """mapInArrow, one task: (a, b) links -> (node, root), by lowering labels along the links."""
    parts = [np.stack([x.column(0).to_numpy(), x.column(1).to_numpy()]) for x in batches]
    if not parts:
        return
    node, at = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    a, b = at.reshape(2, -1)
    label = np.arange(len(node))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)  # labels are nodes: their own labels come down too
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[label])], ["node", "root"])


def components(links: DataFrame, few_links: int = FEW_LINKS) -> DataFrame:
    """``node, root``: every node of ``links(a, b)`` with the smallest node it reaches.

    Alternating large-star and small-star steps: each replaces links by links to
    a smaller node of the same component, so the table never grows, and a node
    with very many links is only ever aggregated (min) or streamed, never listed.
    The number of steps grows with the logarithm of the longest path.  Every
    step is written to the shared checkpoint folder.

    At most ``few_links`` distinct links (a bound whatever the corpus) are joined up by one
    task instead, which spares the steps' many small shuffles; the result is the same.
    """
    links = freeze(links.filter("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b")
                   .distinct(), "links")
    if links.limit(few_links + 1).count() <= few_links:
        return links.coalesce(1).mapInArrow(_joined, "node long, root long")
    while not _are_stars(links):
        both = _both_ways(links)
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        # large star: every larger neighbour of a node goes to the node's minimum
        large = (both.join(low, "a").filter("b > a")
                 .selectExpr("b as a", "least(a, low) as b").distinct())
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(low, "a").selectExpr("case when b = low then a else b end as a", "low as b")
                 .union(low.selectExpr("a", "low as b")).filter("a <> b").distinct())
        done, links = links, freeze(small, "links")
        drop_frozen(done)
    return links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node") \
        .union(links.selectExpr("b as node", "b as root").distinct())
