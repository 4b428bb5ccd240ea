"""Row parity: planted differences, repeated keys, and random tables against plain dictionaries."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from ledgerwright.operators import parity, row_parity

SPEC = {"tables": [{"name": "T", "key": "id", "columns": [{"name": "amount", "kind": "numeric"}, "name"]}]}
TYPES = "id long, amount decimal(19,4), name string"


def table(spark, rows, types=TYPES):
    return {"T": spark.createDataFrame([(i, None if a is None else Decimal(a), n) for i, a, n in rows], types)}


def differences(spark, source, target, spec=SPEC):
    found = row_parity.parity_rows(spark, row_parity.read_row_spec(spec), source, target)
    return sorted((r.key, r["column"], r.source, r.target) for r in found.collect())


def test_swapped_values_that_no_aggregate_shows(spark):
    rows = [(k, str(k), f"n{k}") for k in range(200)]
    swapped = [(k, {50: "51", 51: "50"}.get(k, a), n) for k, a, n in rows]
    source, target = table(spark, rows), table(spark, swapped)
    assert parity.parity_diff(parity.run_parity(spark, parity.read_spec(SPEC), source, target)).collect() == []
    assert differences(spark, source, target) == [("50", "amount", "50", "51"), ("51", "amount", "51", "50")]


def test_missing_repeated_and_null(spark):
    source = [(1, "1", "a"), (2, "2", "b"), (3, None, "x"), (4, "4", None), (5, "5", "e"), (5, "5", "e"), (None, "0", "n"), (7, "7", "g")]
    target = [(1, "1.0", "a  "), (3, "0", "x"), (4, None, "4"), (5, "5", "e"), (5, "6", "e"), (None, "0", "n"), (7, "7", "g"), (7, "7", "g")]
    assert differences(spark, table(spark, source), table(spark, target)) == [
        ("2", "(rows)", "1", "0"),
        ("3", "amount", "NULL", "0"),
        ("4", "amount", "4", "NULL"),
        ("4", "name", "NULL", "4"),
        ("5", "amount", "5", "6"),
        ("7", "(rows)", "0", "1"),
    ]


def test_types_may_differ(spark):
    rows = [(k, f"{k}.25", "t ") for k in range(100)]
    other = spark.createDataFrame([(Decimal(k), k + 0.25, "t") for k in range(100)], "id decimal(38,0), amount double, name string")
    assert differences(spark, table(spark, rows), {"T": other}) == []


def test_equal_tables_are_aggregated_once_and_never_joined(spark):
    side = table(spark, [(k, "1", "a") for k in range(300)])
    checks = row_parity.read_row_spec(SPEC)
    assert row_parity.digest_trees(checks, side, side).leaves.isEmpty()
    plan = row_parity.parity_rows(spark, checks, side, side)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_stored_tables_are_read_by_key_range(spark, tmp_path):
    rows = [(k, "1", "a") for k in range(5000)]
    changed = [(k, "2" if k == 4321 else a, n) for k, a, n in rows]
    sides = []
    for name, data in (("s", rows), ("t", changed)):
        table(spark, data)["T"].repartitionByRange(8, "id").write.parquet(str(tmp_path / name))
        sides.append({"T": spark.read.parquet(str(tmp_path / name))})
    found = row_parity.parity_rows(spark, row_parity.read_row_spec(SPEC), *sides)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in plan and "LessThan(id," in plan
    assert [tuple(r) for r in found.collect()] == [("T", "4321", "amount", "1", "2")]


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    """Composite keys with text and nulls, repeated rows, and several tables at once."""
    rng = random.Random(seed)
    spec = {"tables": [{"name": n, "key": ["k", "j"], "columns": ["v", {"name": "w", "kind": "numeric", "scale": 0}]} for n in "AB"]}
    types = "k string, j int, v string, w long"

    def rows():
        return [
            (rng.choice(["a", "b", "c", "é", None]), rng.choice([1, 2, 3, 4, None]), rng.choice(["x", "y", None]), rng.choice([0, 1, None]))
            for _ in range(40)
        ]

    data = {n: rows() for n in "AB"}
    copy = {"A": data["A"], "B": data["B"][5:] + rows()[:4]}
    expected = []
    counts = defaultdict(Counter)
    for sign, side in ((1, data["B"]), (-1, copy["B"])):
        for k, j, v, w in side:
            counts["/".join("NULL" if x is None else str(x) for x in (k, j))][v, w] += sign
    for key, c in counts.items():
        left, right = [x for x, n in c.items() if n > 0], [x for x, n in c.items() if n < 0]
        n, m = sum(c[x] for x in left), -sum(c[x] for x in right)
        if n == m == 1:
            shown = lambda x: "NULL" if x is None else str(x)
            expected += [(key, name, shown(a), shown(b)) for name, a, b in zip("vw", left[0], right[0], strict=True) if a != b]
        elif n or m:
            expected.append((key, "(rows)", str(n), str(m)))
    sides = [{n: spark.createDataFrame(r, types) for n, r in side.items()} for side in (data, copy)]
    assert differences(spark, *sides, spec) == sorted(expected)


def test_spec_errors():
    for bad, message in (
        ({}, "no tables"),
        ({"tables": [{"name": "T", "columns": ["a"]}]}, "no key"),
        ({"tables": [{"name": "T", "key": "id", "columns": [{"name": "a", "kind": "blob"}]}]}, "kind must be"),
    ):
        with pytest.raises(parity.SpecError, match=message):
            row_parity.read_row_spec(bad)
