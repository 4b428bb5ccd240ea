"""Declared constraints as queries: what storage does not enforce.

An audit reads a table once for all of its constraints of a kind; invariants over
journals read the lines of each journal table once more.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import quoted, rows, total
from ledgerwright.schemas import TABLES, Table


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _present(tables: Mapping[str, DataFrame]) -> list[tuple[Table, DataFrame]]:
    return [(TABLES[name], df) for name, df in tables.items()]


def _key(columns) -> str:
    return f"concat_ws('/', {', '.join(columns)})"


def audit_unique(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once: (table_name, constraint_name, key, copies).

    All keys of a table are grouping sets of one aggregation: one scan and one shuffle
    for each table. Counted by the key columns themselves, so equal keys meet on the
    map side; a key with a NULL is none.
    """
    parts = []
    for table, df in _present(tables):
        keys = {f"PK_{table.name}": table.primary_key} if table.primary_key else {}
        keys |= table.unique
        if not keys:
            continue
        columns = list(dict.fromkeys(c for key in keys.values() for c in key))
        sets = [[F.col(c) for c in key] for key in keys.values()]
        # A bit for each column outside the set, the first column's highest.
        names = {
            sum(1 << len(columns) - 1 - k for k, c in enumerate(columns) if c not in key): name
            for name, key in keys.items()
        }
        whole = " ".join(
            f"WHEN {g} THEN {' AND '.join(f'{c} IS NOT NULL' for c in keys[name])}" for g, name in names.items()
        )
        called = " ".join(f"WHEN {g} THEN '{name}'" for g, name in names.items())
        shown = " ".join(f"WHEN {g} THEN {_key(keys[name])}" for g, name in names.items())
        parts.append(
            df.select(*columns)
            .groupingSets(sets, *[F.col(c) for c in columns])
            .agg(rows().alias("copies"), F.grouping_id().alias("_set"))
            .where(f"copies > 1 AND CASE _set {whole} END")
            .selectExpr(
                f"'{table.name}' AS table_name", f"CASE _set {called} END AS constraint_name",
                f"CASE _set {shown} END AS key", "copies",
            )
        )
    return _union(parts)


def audit_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """References without a parent row: (table_name, constraint_name, key, orphan_rows).

    All references of a table leave it in one pass and are counted per value
    before they meet the parents, so a value that fills a third of the table
    travels as one row. Constraints and parents travel as numbers. A left join
    with a filter stands for the anti join, which Spark would push below the
    union and repeat for every table.
    """
    names, references, parents = [], {}, {}
    for table, df in _present(tables):
        by_type: dict[str, list[str]] = {}
        for fk in table.foreign_keys:
            if fk.parent not in tables:
                continue
            parent = tables[fk.parent]
            type_ = parent.schema[fk.parent_key].dataType.simpleString()
            place = list(tables).index(fk.parent)
            by_type.setdefault(type_, []).append(
                f"struct({len(names)} AS fk, {place} AS parent, CAST({fk.column} AS {type_}) AS key)"
            )
            names.append((table.name, fk.name))
            parents.setdefault(type_, {})[place] = parent.selectExpr(
                f"{place} AS parent", f"{fk.parent_key} AS key", "true AS known"
            )
        for type_, pairs in by_type.items():
            references.setdefault(type_, []).append(
                df.selectExpr(f"inline(array({', '.join(pairs)}))")
                .where("key IS NOT NULL")
                .groupBy("fk", "parent", "key")
                .agg(rows().alias("orphan_rows"))
            )
    labels = ", ".join(f"struct('{t}' AS table_name, '{n}' AS constraint_name)" for t, n in names)
    return _union([
        _union(found)
        .join(_union(list(parents[type_].values())), ["parent", "key"], "left")
        .where("known IS NULL")
        .selectExpr(f"array({labels})[fk] AS label", "CAST(key AS STRING) AS key", "orphan_rows")
        .select("label.*", "key", "orphan_rows")
        for type_, found in references.items()
    ])


def _violations(df: DataFrame, table: Table, broken: dict[str, str], label: str) -> DataFrame:
    names = ", ".join(f"CASE WHEN {condition} THEN {quoted(name)} END" for name, condition in broken.items())
    return df.selectExpr(
        f"'{table.name}' AS table_name",
        f"explode(array_compact(array({names}))) AS {label}",
        f"{_key(table.primary_key)} AS row_key",
    )


def audit_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break a check: (table_name, constraint_name, row_key). NULL passes."""
    return _union([
        _violations(df, table, {n: f"NOT ({c})" for n, c in table.checks.items()}, "constraint_name")
        for table, df in _present(tables)
        if table.checks
    ])


def audit_not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per required column: (table_name, column_name, row_count, null_count)."""
    parts = []
    for table, df in _present(tables):
        counted = df.selectExpr("count(1) AS row_count", *[f"count_if({c} IS NULL) AS {c}" for c in table.required])
        columns = ", ".join(f"struct('{c}' AS column_name, {c} AS null_count)" for c in table.required)
        parts.append(
            counted.selectExpr("row_count", f"explode(array({columns})) AS c").selectExpr(
                f"'{table.name}' AS table_name", "c.column_name", "row_count", "c.null_count"
            )
        )
    return _union(parts)


def audit_invariants(
    ledger: DataFrame, journals: DataFrame, journal_lines: DataFrame, headers: DataFrame
) -> DataFrame:
    """Stored values that no longer follow from the others: (table_name, invariant, row_key).

    Final = original + adjusted; net = debit - credit; a journal's totals and
    balance flag agree with its lines; a budget's lock agrees with its status.
    """
    lines = _violations(
        ledger,
        TABLES["BudgetLineItem"],
        {"final = original + adjusted": "FinalAmount <> OriginalAmount + AdjustedAmount"},
        "invariant",
    )
    nets = _violations(
        journal_lines,
        TABLES["ConsolidationJournalLine"],
        {"net = debit - credit": "NetAmount <> DebitAmount - CreditAmount"},
        "invariant",
    )
    sums = journal_lines.groupBy("JournalID").agg(
        total("DebitAmount").alias("debits"), total("CreditAmount").alias("credits")
    )
    booked = journals.join(sums, "JournalID", "left")
    balances = _violations(
        booked,
        TABLES["ConsolidationJournal"],
        {
            "balanced = debits equal credits": "IsBalanced <> (coalesce(debits, 0) = coalesce(credits, 0))",
            "total debits = sum of lines": "TotalDebits <> coalesce(debits, 0)",
            "total credits = sum of lines": "TotalCredits <> coalesce(credits, 0)",
        },
        "invariant",
    )
    locks = _violations(
        headers,
        TABLES["BudgetHeader"],
        {"locked = status is LOCKED": "IsLocked <> (StatusCode = 'LOCKED')"},
        "invariant",
    )
    return _union([lines, nets, balances, locks])
