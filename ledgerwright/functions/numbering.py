"""Dense row numbers without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import rows
from ledgerwright.functions.stored import materialize

_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above these


def _running(counts: DataFrame, group: list[str], before: str) -> DataFrame:
    """Rows in earlier slices of the same group; one input row per group and slice."""
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(before, F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str, overall: str | None = None) -> DataFrame:
    """Number the rows of each group 1, 2, ... in the given order.

    A row_number window sorts a whole group in one task, which a budget that
    holds a third of the ledger does not survive. Here the rows are range
    partitioned on (group, order), so a large group spans many partitions, and
    stored once with their position. What is left is a running sum over one
    count per (group, partition), stored and joined back to the stored rows. ``overall``
    adds a second number, over all rows in (group, order). ``group`` may be
    empty, its columns must not be NULL; ``order`` must identify a row within
    its group.
    """
    placed = materialize(
        df.repartitionByRange(*[F.col(c) for c in [*group, *order]])
        .sortWithinPartitions(*group, *order)
        .withColumn("_position", F.monotonically_increasing_id()),
        "numbered",
    ).selectExpr("*", f"shiftright(_position, {_SLICE_BITS}) AS _slice")
    counts = placed.groupBy(*group, "_slice").agg(F.min("_position").alias("_first"), rows().alias("_rows"))
    # Stored, its size is known before the rows would be moved to meet it.
    offsets = materialize(_running(counts, group, "_before"), "offsets")
    numbered = placed.join(offsets, [*group, "_slice"])
    numbers = [f"_position - _first + _before + 1 AS {name}"]
    if overall is not None:
        slices = placed.groupBy("_slice").agg(rows().alias("_rows"))
        numbered = numbered.join(_running(slices, [], "_before_all"), "_slice")
        numbers.append(f"_position - shiftleft(_slice, {_SLICE_BITS}) + _before_all + 1 AS {overall}")
    return numbered.selectExpr(*df.columns, *numbers)
