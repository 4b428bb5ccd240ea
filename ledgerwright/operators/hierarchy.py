"""Cost-center hierarchy: ancestor chains, paths, the closure, JSON nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.functions.stored import materialize

#: Nodes of a path at most, and how far below its root a descendant is at most.
PATH_LEVELS = 20
DEPTH = 20


def _codes(chain: str) -> str:
    """Root-to-node path of a node-first chain."""
    return f"array_join(transform(reverse({chain}), n -> n.code), '/')"


def ancestor_chains(centers: DataFrame, levels: int) -> DataFrame:
    """Each cost center with ``chain``: itself, its parent, and so on upwards.

    A chain ends at a node whose parent is absent, or after ``levels`` nodes,
    which also bounds cycles. Only nodes that are somebody's parent take part
    in the loop. Each round doubles the length of their chains, so depth 20
    takes five rounds at most, and a round is stored before the next one reads
    it twice. The remaining nodes join their parent's chain once.
    """
    nodes = centers.selectExpr("CostCenterID AS id", "CostCenterCode AS code", "ParentCostCenterID AS next")
    parents = nodes.where("next IS NOT NULL").selectExpr("next AS id").distinct()
    inner = materialize(
        nodes.join(parents, "id", "left_semi").selectExpr("id", "array(struct(id, code)) AS chain", "next"),
        "chains",
    )
    length = 1
    while length < levels:
        above = inner.selectExpr("id AS next", "chain AS rest", "next AS after")
        inner = materialize(
            inner.join(above, "next", "left").selectExpr(
                "id", "CASE WHEN rest IS NULL THEN chain ELSE concat(chain, rest) END AS chain", "after AS next"
            ),
            "chains",
        )
        length *= 2
        if inner.where("next IS NOT NULL").isEmpty():
            break
    above = inner.selectExpr("id AS ParentCostCenterID", "chain AS rest")
    itself = "array(struct(CostCenterID AS id, CostCenterCode AS code))"
    chain = f"CASE WHEN rest IS NULL THEN {itself} ELSE slice(concat({itself}, rest), 1, {levels}) END AS chain"
    return centers.join(above, "ParentCostCenterID", "left").selectExpr(*centers.columns, chain)


def cost_center_path(
    centers: DataFrame, requested: DataFrame | None = None, levels: int = PATH_LEVELS
) -> DataFrame:
    """Path from the root to each cost center, or to the requested ids only.

    ``literal_path`` is the node's own code. An unknown id gives NULLs.
    """
    paths = ancestor_chains(centers, levels).selectExpr(
        "CostCenterID", f"{_codes('chain')} AS path", "CostCenterCode AS literal_path"
    )
    if requested is None:
        return paths
    return requested.select("CostCenterID").join(paths, "CostCenterID", "left")


def cost_center_explode(centers: DataFrame, roots: DataFrame | None = None, depth: int = DEPTH) -> DataFrame:
    """Active descendants of every active root, the root itself at level 0.

    Walking up from each node gives the same pairs as walking down from each
    root: the chain over active nodes stops at an inactive one, which cuts its
    subtree off. A node yields one row per ancestor, ``depth`` + 1 at most; deeper
    pairs are left out.
    """
    chains = ancestor_chains(centers.where("IsActive"), depth + 1)
    pairs = chains.withColumn("HierarchyLevel", F.expr("explode(sequence(0, size(chain) - 1))")).selectExpr(
        "chain[HierarchyLevel].id AS RootCostCenterID",
        "CostCenterID",
        "CostCenterCode",
        "CostCenterName",
        "ParentCostCenterID",
        "HierarchyLevel",
        f"{_codes('slice(chain, 1, HierarchyLevel + 1)')} AS HierarchyPath",
    )
    if roots is None:
        return pairs
    wanted = roots.selectExpr("CostCenterID AS RootCostCenterID").distinct()
    return pairs.join(wanted, "RootCostCenterID", "left_semi")


def elements(df: DataFrame, json: str) -> DataFrame:
    """One row per element of a JSON array, or per value of an object.

    Adds ``pos`` and the element as variant ``value``. NULL, a scalar and an
    empty array give no rows; malformed JSON is an error.
    """
    spark = df.sparkSession
    return df.lateralJoin(spark.tvf.variant_explode(F.parse_json(F.col(json).outer())))


def field(name: str, type_: str, alias: str | None = None) -> str:
    return f"variant_get(value, '$.{name}', '{type_}') AS {alias or name}"


def hierarchy_nodes(payloads: DataFrame, json: str = "payload") -> DataFrame:
    """Hierarchy nodes of JSON arrays."""
    return elements(payloads, json).selectExpr(
        field("NodeID", "bigint"),
        field("ParentNodeID", "bigint"),
        field("NodeLevel", "int"),
        field("NodePath", "string"),
        field("SortOrder", "int"),
        field("IsLeaf", "boolean"),
        field("AggregationWeight", "decimal(8,6)"),
    )
