"""Cycles of self references against walks in plain Python, and a very long chain."""

from __future__ import annotations

import random

import pytest

from ledgerwright.operators import cycles
from ledgerwright.schemas import TABLES


def found(spark, parents):
    frame = spark.createDataFrame([("g", i, p) for i, p in parents.items() if p is not None], "g string, id long, parent long")
    return sorted((r.cycle, r.length, r.hanging) for r in cycles.cycles(frame, ["g"]).collect())


def walked(parents):
    rings = {}
    for i in parents:
        seen = {}
        while i is not None and i not in seen:
            seen[i] = len(seen)
            i = parents.get(i)
        if i is not None:
            rings.setdefault(min(list(seen)[seen[i] :]), [len(seen) - seen[i], 0])[1] += 1
    return sorted((c, n, m - n) for c, (n, m) in rings.items())


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 5, 60, 400])
    parents = {i: rng.choice([None, *[rng.randrange(n + n // 4 + 1)] * 9]) for i in range(n)}
    assert found(spark, parents) == walked(parents)


def test_shapes(spark):
    """A row that refers to itself, a ring with a tail and leaves, two rings, a parent that is missing."""
    parents = {1: 1, 2: 3, 3: 4, 4: 2, 5: 2, 6: 5, 7: 5, 10: 11, 11: 10, 20: 99, 21: 20, 22: None}
    assert found(spark, parents) == [(1, 1, 0), (2, 3, 3), (10, 2, 0)] == walked(parents)
    assert found(spark, {1: 2, 2: 3, 3: None}) == []


def test_a_long_chain_and_a_long_ring(spark):
    assert found(spark, {i: i + 1 for i in range(100_000)}) == []
    ring = {i: (i + 1) % 3000 for i in range(3000)} | {i: i - 1 for i in range(3000, 4000)}
    assert found(spark, ring) == [(0, 3000, 1000)]


def test_every_declared_self_reference(spark, sample):
    tables = {n: sample[n] for n in sample if n in TABLES}
    assert cycles.audit_cycles(tables).collect() == []
    names = {r.constraint_name for r in cycles.self_references(
        {"CostCenter": tables["CostCenter"], "GLAccount": tables["GLAccount"]}).select("constraint_name").distinct().collect()}
    assert "FK_CostCenter_Parent" in names
    with pytest.raises(ValueError, match="refers to itself"):
        cycles.self_references({"FiscalPeriod": tables["FiscalPeriod"]})
