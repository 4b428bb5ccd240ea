"""Subtrees of a hierarchy as ranges of numbers, in storage linear in its rows.

A tour of a forest enters and leaves every row once, children in order of their id. A row's
descendants are those that are entered between its own entering and leaving. The tour is
a linked list: each row has two places on it, and where each of them leads is known from
the row's parent, its next sibling and its first child alone. Places are numbered by
pointer jumping: each round joins every place's target with the target's own jump and
adds up the way, so a chain of a million rows takes about 21 rounds over rows of a few
numbers, and no row's list of ancestors or descendants is ever stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.functions.stored import materialize

DEPTH = 20


def subtree_labels(nodes: DataFrame, id_: str, parent: str) -> DataFrame:
    """``id_, first, last, level`` of every row of a forest.

    Places count from 1 over all trees, trees in order of their root's id. A row whose parent
    is not there is a root. Rows on a cycle, and below one, hang on no root and have no label.
    """
    rows = nodes.select(F.col(id_).alias("id"), F.col(parent).alias("parent"))
    known = rows.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
    rows = materialize(rows.join(known, "parent", "left").selectExpr("id", "IF(known, parent, NULL) AS parent"), "forest")

    # Next siblings by a sort of (parent, id) over many tasks: a parent with very many children is no task of its own.
    siblings = _next_sibling(rows)
    first = rows.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.min("id").alias("child"))
    linked = siblings.join(first, "id", "left")
    # A place is (id, out): 0 where a row is entered, 1 where it is left.
    into = linked.selectExpr("id", "0 AS out", "coalesce(child, id) AS to_id", "IF(child IS NULL, 1, 0) AS to_out", "1 AS up")
    leave = linked.selectExpr(
        "id", "1 AS out", "coalesce(sibling, parent) AS to_id", "IF(sibling IS NULL, 1, 0) AS to_out", "-1 AS up"
    )
    # How far the end is, and how many more rows are entered than left from here on.
    state = into.unionAll(leave).selectExpr("id", "out", "to_id", "IF(to_id IS NULL, NULL, to_out) AS to_out", "1L AS way", "up")
    state = materialize(state, "tour")
    places, reach = state.count(), 1
    while reach < places:
        ahead = state.selectExpr("id AS to_id", "out AS to_out", "to_id AS next_id", "to_out AS next_out", "way AS more", "up AS rise")
        state = state.join(ahead, ["to_id", "to_out"], "left").selectExpr(
            "id", "out", "next_id AS to_id", "next_out AS to_out", "way + coalesce(more, 0) AS way", "up + coalesce(rise, 0) AS up"
        )
        state, reach = materialize(state, "tour"), 2 * reach
        if state.where("to_id IS NOT NULL").isEmpty():
            break
    ended = state.where("to_id IS NULL")
    end = ended.agg(F.max("way")).first()[0] or 0
    # From a row's entering to the end, one leaving more is left for each of its ancestors.
    labels = ended.groupBy("id").agg(
        F.max(F.expr("IF(out = 0, way, NULL)")).alias("enter"),
        F.max(F.expr("IF(out = 1, way, NULL)")).alias("leave"),
        F.max(F.expr("IF(out = 0, -up, NULL)")).alias("level"),
    )
    return labels.selectExpr(
        f"id AS {id_}", f"{end} - enter + 1 AS first", f"{end} - leave + 1 AS last", "CAST(level AS INT) AS level"
    )


def _next_sibling(rows: DataFrame) -> DataFrame:
    """``id, parent, sibling``: the next id of the same parent; roots are siblings of each other."""
    order = [F.col("parent").asc_nulls_first(), F.col("id")]
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "siblings"
    )
    inner = Window.partitionBy("part").orderBy(*order)
    follows = placed.withColumn("next", F.lead(F.struct("parent", "id")).over(inner))
    # The first row of the next partition that has any: one row for each partition.
    heads = placed.groupBy("part").agg(F.min_by(F.struct("parent", "id"), F.struct(F.expr("parent IS NOT NULL"), "parent", "id")).alias("head"))
    heads = heads.select("part", F.lead("head").over(Window.orderBy("part")).alias("after"))
    both = follows.join(heads, "part").selectExpr("id", "parent", "coalesce(next, after) AS next")
    return both.selectExpr("id", "parent", "IF(next.parent <=> parent, next.id, NULL) AS sibling")


def descendants(labels: DataFrame, root, id_: str, depth: int = DEPTH) -> DataFrame:
    """``id_, level`` of one row and what is below it, from stored labels: a filter on a range of places."""
    found = labels.where(F.col(id_) == root).select("first", "last", "level").first()
    if found is None:
        return labels.select(id_, "level").limit(0)
    inside = labels.where(F.col("first").between(found["first"], found["last"]))
    return inside.select(id_, (F.col("level") - found["level"]).alias("level")).where(F.col("level") <= depth)


def center_labels(centers: DataFrame) -> DataFrame:
    """Labels of the active cost centers; an inactive one cuts off what is below it."""
    return subtree_labels(centers.where("IsActive"), "CostCenterID", "ParentCostCenterID")
