"""Cycles in references of a table to itself, such as a parent account or the rule a rule depends on.

Following such a reference, every row goes to at most one other. Rows nobody refers to
cannot be on a cycle and wait until the end. The others jump 1, 2, 4, 8 ... references
ahead: each round joins every row's target with the target's own jump. A row whose way
ends drops out, so a hierarchy without a cycle is gone once the jumps are longer than its
depth, whatever that is; a chain of a million rows takes 20 rounds. Each row keeps the
least id on its way. What stays never ends, and once the jumps are as long as there are
rows left, they all lead onto a cycle, and the least id on a way there names it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import rows
from ledgerwright.functions.stored import materialize
from ledgerwright.schemas import TABLES

_ID = "DECIMAL(38,0)"


def self_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, constraint_name, id, parent`` of every reference within one of the given tables."""
    found = []
    for name, df in tables.items():
        for fk in TABLES[name].foreign_keys:
            if fk.parent == name and fk.column in df.columns:
                found.append(
                    df.where(f"{fk.column} IS NOT NULL").selectExpr(
                        f"'{name}' AS table_name", f"'{fk.name}' AS constraint_name",
                        f"CAST({fk.parent_key} AS {_ID}) AS id", f"CAST({fk.column} AS {_ID}) AS parent",
                    )
                )
    if not found:
        raise ValueError("no given table refers to itself")
    return reduce(DataFrame.unionAll, found)


def cycles(references: DataFrame, group: list[str]) -> DataFrame:
    """``group, cycle, length, hanging``: the least id of each cycle, its rows, and the other rows that lead to it.

    ``references`` are (group, id, parent). An id that occurs again goes to its least parent.
    """
    edges = references.groupBy(*group, "id").agg(F.min("parent").alias("parent"))
    edges = materialize(edges, "references")
    referred = edges.select(*group, F.col("parent").alias("id")).distinct()
    inner = edges.join(referred, [*group, "id"], "left_semi")
    state = materialize(inner.select(*group, F.col("id").alias("node"), F.col("parent").alias("jump"), F.col("id").alias("low")), "jumps")
    before, left, steps, endless = None, state.count(), 1, False
    while left and not (endless and steps >= left):
        ahead = state.select(*group, F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("low").alias("least"))
        state = state.join(ahead, [*group, "jump"]).select(
            *group, "node", F.col("next").alias("jump"), F.least("low", "least").alias("low")
        )
        state = materialize(state, "jumps")
        before, left, steps = left, state.count(), 2 * steps
        # No way of the last length ended, so no longer one does.
        endless = endless or before == left
    ring = materialize(
        state.join(state.select(*group, F.col("jump").alias("node")).distinct(), [*group, "node"], "left_semi")
        .select(*group, F.col("node").alias("id"), F.col("low").alias("cycle")),
        "rings",
    )
    lead = state.select(*group, F.col("node").alias("at"), F.col("jump").alias("id")).join(ring, [*group, "id"])
    lead = materialize(lead.select(*group, F.col("at").alias("parent"), "cycle"), "leads")
    # Rows nobody refers to are counted for each parent first.
    leaves = edges.join(referred, [*group, "id"], "left_anti").groupBy(*group, "parent").agg(rows().alias("hanging"))
    leaves = leaves.join(lead, [*group, "parent"]).select(*group, "cycle", "hanging")
    tails = lead.select(*group, "cycle", F.lit(1).cast("long").alias("hanging"))
    on = ring.groupBy(*group, "cycle").agg(rows().alias("length"))
    all_ = tails.unionAll(leaves).groupBy(*group, "cycle").agg(F.sum("hanging").alias("n"))
    return on.join(all_, [*group, "cycle"]).selectExpr(*group, "cycle", "length", "n - length AS hanging")


def audit_cycles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Cycles in the self references of the given tables: (table_name, constraint_name, cycle, length, hanging)."""
    found = cycles(self_references(tables), ["table_name", "constraint_name"])
    return found.withColumn("cycle", F.col("cycle").cast("string"))
