"""Parity of two copies of a dataset, row by row, by trees of digests.

Equal aggregates do not make equal rows: two rows may have swapped a value. Here every row
gets a digest of its key and its compared columns, in the form in which they are compared.
A table's tree has a range of the first key column at its first level and parts of the
key's hash below; a node holds the number of rows and the sums of two digests. Both sides
are reduced to the leaves of their trees in one aggregation, so equal copies cost a scan
each and nothing else. Below the nodes that differ the rows of both sides are counted
against each other by key and values; what does not cancel out differs. The key ranges
also reach the scan of a stored table as filters, so files of equal ranges are not read.

Numbers are compared at their declared scale, text without blanks at the end. Nulls are
equal to nulls. A repeated key is no error: its rows are matched by their values.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwright.functions.exprs import quoted
from ledgerwright.functions.stored import materialize
from ledgerwright.functions.text import BLANKS_AT_END
from ledgerwright.operators.parity import AGGREGATES, DEFAULT_SCALE, SpecError, _plain, _required

#: Ranges of the first key column, and keys that are drawn to find them.
RANGES = 64
SAMPLE = 1024
#: Bits of the key's hash below a range: four for each further level of the tree.
HASH_BITS = 8
#: What stands for a whole row in the result.
ROWS = "(rows)"
_WIDE = "DECIMAL(38,0)"


@dataclass(frozen=True)
class RowCheck:
    """Key and compared columns of a table; columns are (name, kind, scale)."""

    key: tuple[str, ...]
    columns: tuple[tuple[str, str, int], ...]


def read_row_spec(given: Mapping) -> dict[str, RowCheck]:
    """Checks from the ``tables`` of a parity spec. ``key`` is a column, or a list of them."""
    if not (given or {}).get("tables"):
        raise SpecError("the spec declares no tables")
    out = {}
    for entry in given["tables"]:
        table, key = _required(entry, "a table"), entry.get("key")
        if not key:
            raise SpecError(f"{table} has no key")
        columns = []
        for column in entry.get("columns") or []:
            column = {"name": column} if isinstance(column, str) else column
            name, kind = _required(column, f"a column of {table}"), column.get("kind", "text")
            if kind not in AGGREGATES:
                raise SpecError(f"{table}.{name}: kind must be one of {sorted(AGGREGATES)}")
            columns.append((name, kind, int(column.get("scale", DEFAULT_SCALE))))
        out[table] = RowCheck((key,) if isinstance(key, str) else tuple(key), tuple(columns))
    return out


def _text(name: str, type_: T.DataType) -> str:
    """The column as text; blanks at the end go, and only a text that may end in one meets the pattern."""
    if not isinstance(type_, T.StringType):
        return f"CAST(`{name}` AS STRING)"
    trimmed = f"regexp_replace(`{name}`, {quoted(BLANKS_AT_END)}, '')"
    return f"IF(right(`{name}`, 1) BETWEEN '!' AND '~', `{name}`, {trimmed})"


def _key_text(name: str, type_: T.DataType) -> str:
    """A key as text, the same for equal values of different numeric types."""
    if isinstance(type_, (T.FloatType, T.DoubleType)):
        return _plain(f"CAST(`{name}` AS DECIMAL(38,10))")
    if isinstance(type_, T.DecimalType) and type_.scale:
        return _plain(f"`{name}`")
    return _text(name, type_)


def _value_text(name: str, kind: str, scale: int, type_: T.DataType) -> str:
    if kind == "numeric":
        exact = f"CAST(`{name}` AS DECIMAL(38,{scale}))"
        return _plain(exact) if scale else f"CAST({exact} AS STRING)"
    return _text(name, type_)


def _between(first: str, bounds: list[str], low: int, high: int) -> str:
    """The number of the range that holds ``first``, by halving; nulls are in the last one."""
    if low == high:
        return str(low)
    middle = (low + high) // 2
    return (
        f"IF({first} < {bounds[middle]}, {_between(first, bounds, low, middle)},"
        f" {_between(first, bounds, middle + 1, high)})"
    )


def _canonical(df: DataFrame, check: RowCheck, first: str, bounds: list[str]) -> DataFrame:
    """``range, leaf, key, v0, v1, ...`` of every row."""
    key = "concat_ws('/', " + ", ".join(f"coalesce({_key_text(k, df.schema[k].dataType)}, 'NULL')" for k in check.key) + ")"
    values = [f"{_value_text(*c, df.schema[c[0]].dataType)} AS v{n}" for n, c in enumerate(check.columns)]
    placed = df.selectExpr(f"{_between(first, bounds, 0, len(bounds))} AS range", f"{key} AS key", *values)
    leaf = f"CAST(pmod(xxhash64(key), {1 << HASH_BITS}) AS INT) AS leaf"
    return placed.selectExpr("range", leaf, "key", *[f"v{n}" for n in range(len(values))])


def _leaves(rows: DataFrame, table: str, columns: int, sign: int) -> DataFrame:
    """Number of rows and sums of two digests of each leaf, positive on one side and negative on the other.

    A null is marked, since a hash skips it.
    """
    parts = ", ".join(["key", *[f"v{n}, v{n} IS NULL" for n in range(columns)]])
    return (
        rows.selectExpr("range", "leaf", f"xxhash64({parts}) AS a", f"xxhash64('again', {parts}) AS b")
        .groupBy("range", "leaf")
        .agg(
            F.expr(f"{sign} * count(1)").alias("rows"),
            F.expr(f"{sign} * sum(CAST(a AS {_WIDE}))").cast(_WIDE).alias("a"),
            F.expr(f"{sign} * sum(CAST(b AS {_WIDE}))").cast(_WIDE).alias("b"),
        )
        .withColumn("table", F.lit(table))
    )


def _typed(df: DataFrame, name: str, type_: T.DataType) -> str:
    """The column, cast where the other side has another type."""
    return f"`{name}`" if df.schema[name].dataType == type_ else f"CAST(`{name}` AS {type_.simpleString()})"


def range_bounds(checks: Mapping[str, RowCheck], source: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Where the first key column of each table is cut, as SQL literals.

    The cuts are quantiles of the ``SAMPLE`` keys of least hash: that many values a table
    come to the driver, whatever its size.
    """
    drawn = []
    for table, check in checks.items():
        keys = source[table].selectExpr(f"`{check.key[0]}` AS k").where("k IS NOT NULL")
        least = keys.selectExpr("CAST(k AS STRING) AS k", "xxhash64(k) AS h").orderBy("h").limit(SAMPLE)
        drawn.append(least.select(F.lit(table).alias("table"), "k"))
    found = defaultdict(set)
    for row in reduce(DataFrame.unionAll, drawn).collect():
        found[row.table].add(row.k)
    out = {}
    for table, check in checks.items():
        type_ = source[table].schema[check.key[0]].dataType
        keys = list(found[table])
        if isinstance(type_, T.NumericType):
            keys.sort(key=float)
        elif isinstance(type_, T.StringType):
            keys.sort(key=str.encode)
        else:
            keys.sort()
        cuts = keys[len(keys) // RANGES :: max(1, len(keys) // RANGES)][: RANGES - 1] if len(keys) > RANGES else keys[1:]
        out[table] = [f"CAST({quoted(k)} AS {type_.simpleString()})" for k in cuts]
    return out


@dataclass(frozen=True)
class Trees:
    """Both sides of all tables, and the stored leaves (table, range, leaf) that differ."""

    checks: Mapping[str, RowCheck]
    sides: Mapping[str, tuple[DataFrame, DataFrame]]
    first: Mapping[str, tuple[str, str]]
    bounds: Mapping[str, list[str]]
    leaves: DataFrame


def digest_trees(
    checks: Mapping[str, RowCheck], source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]
) -> Trees:
    """Trees of all tables of both sides, reduced in one aggregation; only leaves that differ are stored."""
    for name, tables in (("source", source), ("target", target)):
        missing = [t for t in checks if t not in tables]
        if missing:
            raise KeyError(f"{name} has no table {missing[0]}")
    bounds = range_bounds(checks, source)
    sides, firsts, leaves = {}, {}, []
    for table, check in checks.items():
        type_ = source[table].schema[check.key[0]].dataType
        sides[table] = source[table], target[table]
        firsts[table] = tuple(_typed(df, check.key[0], type_) for df in sides[table])
        for df, first, sign in zip(sides[table], firsts[table], (1, -1), strict=True):
            leaves.append(_leaves(_canonical(df, check, first, bounds[table]), table, len(check.columns), sign))
    both = reduce(DataFrame.unionByName, leaves).groupBy("table", "range", "leaf")
    # Each leaf has one row a side: what the two do not have in common differs.
    differ = both.agg(*[F.sum(c).alias(c) for c in ("rows", "a", "b")]).where("rows <> 0 OR a <> 0 OR b <> 0")
    return Trees(checks, sides, firsts, bounds, materialize(differ.select("table", "range", "leaf"), "leaves"))


def _in_ranges(first: str, bounds: list[str], ranges: list[int]) -> str:
    """Rows of the given ranges as a condition on the first key column; neighbours are joined."""
    runs: list[list[int]] = []
    for n in sorted(ranges):
        if runs and runs[-1][1] == n - 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    parts = []
    for low, high in runs:
        limits = [f"{first} >= {bounds[low - 1]}"] if low else []
        limits += [f"{first} < {bounds[high]}"] if high < len(bounds) else []
        part = " AND ".join(limits) or "TRUE"
        parts.append(f"({part} OR {first} IS NULL)" if high == len(bounds) else f"({part})")
    return " OR ".join(parts)


def row_differences(trees: Trees, table: str, ranges: list[int]) -> DataFrame:
    """``table, key, column, source, target`` of the rows below the leaves of a table that differ."""
    check, bounds = trees.checks[table], trees.bounds[table]
    names = [f"v{n}" for n in range(len(check.columns))]
    leaves = trees.leaves.where(F.col("table") == table).select("range", "leaf")
    sides = []
    for df, first, sign in zip(trees.sides[table], trees.first[table], (1, -1), strict=True):
        rows = _canonical(df.where(_in_ranges(first, bounds, ranges)), check, first, bounds)
        sides.append(rows.join(leaves, ["range", "leaf"], "left_semi").selectExpr("key", *names, f"{sign} AS n"))
    left = sides[0].unionAll(sides[1]).groupBy("key", *names).agg(F.sum("n").alias("n")).where("n <> 0")
    values = f"named_struct({', '.join(f'{quoted(v)}, {v}' for v in names) or quoted('none') + ', 0'})"
    by_key = left.groupBy("key").agg(
        F.expr("sum(if(n > 0, n, 0))").alias("source"),
        F.expr("sum(if(n < 0, -n, 0))").alias("target"),
        F.expr(f"max(if(n > 0, {values}, NULL))").alias("s"),
        F.expr(f"max(if(n < 0, {values}, NULL))").alias("t"),
    )
    # One row on each side: the columns that differ. Otherwise how many rows have no equal one.
    columns = [
        f"struct({quoted(c[0])} AS column, coalesce(s.{v}, 'NULL') AS source, coalesce(t.{v}, 'NULL') AS target,"
        f" NOT (s.{v} <=> t.{v}) AS differs)"
        for c, v in zip(check.columns, names, strict=True)
    ]
    counts = "CAST(source AS STRING) AS source, CAST(target AS STRING) AS target"
    whole = f"array(struct('{ROWS}' AS column, {counts}, TRUE AS differs))"
    single = f"IF(source = 1 AND target = 1, array({', '.join(columns)}), {whole})" if columns else whole
    return (
        by_key.selectExpr("key", f"explode({single}) AS d")
        .where("d.differs")
        .selectExpr(f"{quoted(table)} AS table", "key", "d.column", "d.source", "d.target")
    )


def parity_rows(
    spark: SparkSession,
    checks: Mapping[str, RowCheck],
    source: Mapping[str, DataFrame],
    target: Mapping[str, DataFrame],
) -> DataFrame:
    """Every value that differs between rows of one key, and the keys whose rows differ in number.

    The trees are measured now. What comes to the driver are the ranges that differ.
    """
    trees = digest_trees(checks, source, target)
    ranges = defaultdict(list)
    for row in trees.leaves.select("table", "range").distinct().collect():
        ranges[row.table].append(row.range)
    empty = spark.createDataFrame([], "table STRING, key STRING, column STRING, source STRING, target STRING")
    return reduce(DataFrame.unionAll, [row_differences(trees, t, found) for t, found in sorted(ranges.items())] or [empty])
