"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import cut


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its smallest one; one aggregation and one join.

    The neighbours are never collected: the minimum is a plain aggregate that combines before the shuffle,
    and a node with very many edges is a join key that AQE splits.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(lowest, "a")
    keep = linked.where("b > a") if large else linked
    out = keep.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(linked.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


#: Graphs of at most so many edges are solved by one task; larger ones by rounds of joins, with the same result.
FEW_EDGES = 200_000


def _union_find(frames):
    """The components of all edges of one task."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for pdf in frames:
        for x, y in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            p, q = find(root.setdefault(x, x)), find(root.setdefault(y, y))
            if p != q:
                root[max(p, q)] = min(p, q)
    yield pd.DataFrame([(x, find(x)) for x in root], columns=["node", "component"], dtype="int64")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40, few: int = FEW_EDGES) -> DataFrame:
    """(node, component): every node of ``edges``, a long, with the smallest node of its component.

    Loops and null ends are ignored; repeated edges do no harm; no edges give no rows.
    """
    links = cut(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b").distinct())
    if links.count() <= few:
        return links.coalesce(1).mapInPandas(_union_find, "node long, component long")
    before = None
    for _ in range(rounds):
        links = cut(_stars(_stars(links, True), False))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
