"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import materialize

#: Rounds before giving up; stars need about the logarithm of the longest path.
MOST_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the others and itself) linked to the least.

    The least is found by a partial aggregate; only then do a hub's links meet it, in a join
    that adaptive execution splits.
    """
    if large:
        near = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = near.join(least, "a")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (a, b); the root is the least node reachable.

    Every round is written to the shared folder, so no lineage grows; the driver sees two
    numbers of it. Nodes are numbers; links may repeat, run either way, or join a node to itself.
    """
    now = materialize(
        links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).filter("a <> b").distinct()
    )
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    state = None
    for _ in range(MOST_ROUNDS):
        now = materialize(_star(_star(now, large=True), large=False))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError(f"components: no end after {MOST_ROUNDS} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialize(
        nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    )
