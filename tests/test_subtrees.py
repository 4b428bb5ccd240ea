"""Tour labels against walks in plain Python and against the stored closure."""

from __future__ import annotations

import random

import pytest

from ledgerwright.operators import hierarchy, subtrees


def labels(spark, parents):
    frame = spark.createDataFrame(list(parents.items()), "id long, parent long")
    return {r.id: (r["first"], r["last"], r.level) for r in subtrees.subtree_labels(frame, "id", "parent").collect()}


def walked(parents):
    children, out, place = {}, {}, 0
    for i in sorted(parents):
        children.setdefault(parents[i] if parents[i] in parents else None, []).append(i)
    stack = [(i, 0, False) for i in reversed(children.get(None, []))]
    while stack:
        i, level, done = stack.pop()
        place += 1
        if done:
            out[i] = (out[i][0], place, level)
            continue
        out[i] = (place, None, level)
        stack.append((i, level, True))
        stack += [(c, level + 1, False) for c in reversed(children.get(i, []))]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_forests(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(10_000), rng.choice([1, 2, 50, 500]))
    parents = {i: rng.choice([None, 99_999, *ids[:k], *ids[:k]]) if k else None for k, i in enumerate(ids)}
    assert labels(spark, parents) == walked(parents)


def test_shapes(spark):
    """A long chain, a parent with all the children, a cycle with a tail beside a tree, and nothing."""
    chain = {k: k - 1 if k else None for k in range(3000)}
    assert labels(spark, chain) == walked(chain)
    star = {k: 0 if k else None for k in range(2000)}
    assert labels(spark, star) == walked(star)
    assert labels(spark, {1: None, 2: 1, 10: 11, 11: 10, 12: 10}) == {1: (1, 4, 0), 2: (2, 3, 1)}
    assert labels(spark, {}) == {}


def test_descendants_are_those_of_the_closure(spark, sample):
    """Also below inactive centers, which cut their subtrees off, and with a bound on the depth."""
    centers = sample["CostCenter"]
    found = subtrees.center_labels(centers).cache()
    for depth in (1, 20):
        closure = {}
        for r in hierarchy.cost_center_explode(centers, depth=depth).collect():
            closure.setdefault(r.RootCostCenterID, set()).add((r.CostCenterID, r.HierarchyLevel))
        for root, below in closure.items():
            assert {tuple(r) for r in subtrees.descendants(found, root, "CostCenterID", depth).collect()} == below
    assert subtrees.descendants(found, -1, "CostCenterID").collect() == []
