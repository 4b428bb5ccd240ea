"""Connected components of links by alternating stars, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.llm.shared import Workspace


def _star(space: Workspace, links: DataFrame, rows: int, large: bool) -> DataFrame:
    """One star step over ``rows`` links (a, b) with a > b.

    The large star hangs every larger neighbour of a node on the least node of its
    neighbourhood, the small star every smaller one and the node itself.
    """
    if large:
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select("a", "b")
    least = space.store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least", 2 * rows)
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a > b").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )


def components(space: Workspace, links: DataFrame) -> DataFrame:
    """(node, component) for every node of a link (a, b), stored; the component is its least node.

    Ids may have any ordered type. Links to itself and repeated links do no harm.
    Steps alternate until the set of links stops changing; each is stored, so
    neither the lineage nor the work of a lost executor grows with the rounds, and
    goes with the last. A node with very many links is reduced on the map side and
    its join can be split.
    """
    with space.inner("stars") as steps:
        links = steps.store(
            links.where("a != b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            "links",
        )
        before = None
        while (mark := _mark(links)) != before and mark[0]:
            before = mark
            # A large star keeps at most the links, a small star adds one for each of its nodes.
            links = steps.store(_star(steps, links, mark[0], True), "large", mark[0])
            links = steps.store(_star(steps, links, mark[0], False), "small", 2 * mark[0])
        roots = links.select(F.col("b").alias("node")).distinct()
        found = links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
            roots.select("node", F.col("node").alias("component"))
        )
        return space.store(found, "components", 2 * mark[0])
