"""Parity of two copies of a dataset, from aggregates.

One aggregation per table and side; what is compared afterwards is one row per
declared metric.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwright.functions.exprs import quoted, rows
from ledgerwright.functions.text import BLANKS_AT_END

#: Column kinds and their aggregates, default scale and tolerance,
#: length of an error text.
AGGREGATES = {
    "numeric": ("count", "sum", "min", "max"),
    "text": ("count", "min", "max"),
    "date": ("count", "min", "max"),
}
DEFAULT_SCALE = 4
DEFAULT_TOLERANCE = Decimal("0.0001")
ERROR_LENGTH = 200


class SpecError(ValueError):
    """The parity spec is missing or malformed."""


@dataclass(frozen=True)
class Measure:
    """One aggregate of a table's column; the row count has no column."""

    how: str
    column: str | None = None
    scale: int = DEFAULT_SCALE

    @property
    def metric(self) -> str:
        return f"{self.column}__{self.how}".lower() if self.column else "row_count"

    @property
    def value(self) -> str:
        if not self.column:
            return "count(1)"
        if self.how == "sum":
            exact = f"DECIMAL(38,{self.scale})"
            return f"CAST(sum(CAST(`{self.column}` AS {exact})) AS {exact})"
        return f"{self.how}(`{self.column}`)"


#: What to measure, by table.
Spec = dict[str, tuple[Measure, ...]]


def _required(entry: Mapping, what: str) -> str:
    if not entry.get("name"):
        raise SpecError(f"{what} has no name")
    return entry["name"]


def _measures(table: str, columns: list) -> Iterator[Measure]:
    yield Measure("count")
    for given in columns:
        column = {"name": given} if isinstance(given, str) else given
        name, kind = _required(column, f"a column of {table}"), column.get("kind", "text")
        if kind not in AGGREGATES:
            raise SpecError(f"{table}.{name}: kind must be one of {sorted(AGGREGATES)}")
        for how in AGGREGATES[kind]:
            yield Measure(how, name, int(column.get("scale", DEFAULT_SCALE)))


def read_spec(given: Mapping | str | Path | None) -> Spec:
    """Measures from a mapping, or from a JSON file, or a YAML one where PyYAML is installed.

    Every entry of ``tables`` has a name and columns: names alone, or with a kind and
    a scale. Other fields are not used here; both sides are given as DataFrames.
    """
    if isinstance(given, (str, Path)):
        given = _loaded(Path(given))
    tables = (given or {}).get("tables")
    if not tables:
        raise SpecError("the spec declares no tables")
    return {
        (name := _required(entry, "a table")): tuple(_measures(name, entry.get("columns") or [])) for entry in tables
    }


def _loaded(path: Path) -> Mapping:
    try:
        text = path.read_text(encoding="utf-8")
        if path.suffix == ".json":
            return json.loads(text)
        import yaml

        return yaml.safe_load(text)
    except ImportError as error:
        raise SpecError("a YAML spec needs PyYAML; JSON does not") from error
    except OSError as error:
        raise SpecError(f"no parity spec at {path}") from error
    except ValueError as error:  # what json raises
        raise SpecError(f"{path} cannot be read: {error}") from error


def places(spec: Spec) -> int:
    """Decimals that metric values keep: ten, or one more than the largest scale; a subtraction loses one."""
    return max([10, *(m.scale + 1 for measures in spec.values() for m in measures)])


#: The columns compared per planning table.
PLANNING_SPEC = {
    "tables": [
        {
            "name": "FiscalPeriod",
            "key": "FiscalPeriodID",
            "columns": [
                {"name": "FiscalYear", "kind": "numeric", "scale": 0},
                {"name": "FiscalMonth", "kind": "numeric", "scale": 0},
                {"name": "PeriodStartDate", "kind": "date"},
                {"name": "PeriodEndDate", "kind": "date"},
                {"name": "PeriodName", "kind": "text"},
            ],
        },
        {"name": "GLAccount", "key": "GLAccountID", "columns": ["AccountNumber", "AccountName", "AccountType"]},
        {
            "name": "CostCenter",
            "key": "CostCenterID",
            "columns": ["CostCenterCode", "CostCenterName", {"name": "AllocationWeight", "kind": "numeric"}],
        },
        {
            "name": "AllocationRule",
            "key": "AllocationRuleID",
            "columns": ["RuleCode", {"name": "ExecutionSequence", "kind": "numeric", "scale": 0}, "AllocationBasis"],
        },
        {
            "name": "BudgetHeader",
            "key": "BudgetHeaderID",
            "columns": ["BudgetCode", {"name": "FiscalYear", "kind": "numeric", "scale": 0}, "StatusCode"],
        },
        {
            "name": "BudgetLineItem",
            "key": "BudgetLineItemID",
            "columns": [
                {"name": "OriginalAmount", "kind": "numeric"},
                {"name": "AdjustedAmount", "kind": "numeric"},
                {"name": "FinalAmount", "kind": "numeric"},
            ],
        },
        {
            "name": "ConsolidationJournal",
            "key": "JournalID",
            "columns": ["JournalNumber", "JournalType", {"name": "PostingDate", "kind": "date"}],
        },
        {
            "name": "ConsolidationJournalLine",
            "key": "JournalLineID",
            "columns": [
                {"name": "DebitAmount", "kind": "numeric"},
                {"name": "CreditAmount", "kind": "numeric"},
                {"name": "NetAmount", "kind": "numeric"},
            ],
        },
    ]
}


def _is_number(type_: T.DataType) -> bool:
    return isinstance(type_, T.NumericType)


def _plain(number: str) -> str:
    """A decimal with decimals as text, without trailing zeros or an exponent."""
    return f"rtrim('.', rtrim('0', CAST({number} AS STRING)))"


def _as_text(value: str, type_: T.DataType, number: str) -> str:
    """The value as it is reported: plain numbers, no blanks at the end."""
    if _is_number(type_):
        return _plain(f"CAST({value} AS {number})")
    if isinstance(type_, T.BooleanType):
        return f"upper(CAST({value} AS STRING))"
    return f"regexp_replace(CAST({value} AS STRING), {quoted(BLANKS_AT_END)}, '')"


def parity_metrics(table: str, measures: tuple[Measure, ...], df: DataFrame, decimals: int = 10) -> DataFrame:
    """(table, metric, number, text): the row count and the aggregates of each column.

    ``number`` is set for numeric values only; ``text`` is the reported form.
    """
    number = f"DECIMAL(38,{decimals})"
    one_row = df.selectExpr(*[f"{m.value} AS `{m.metric}`" for m in measures])
    values = []
    for f in one_row.schema:
        value = f"`{f.name}`" if _is_number(f.dataType) else "NULL"
        values.append(
            f"struct('{f.name}' AS metric, CAST({value} AS {number}) AS number,"
            f" {_as_text(f'`{f.name}`', f.dataType, number)} AS text)"
        )
    return one_row.selectExpr(f"explode(array({', '.join(values)})) AS m").selectExpr(
        f"{quoted(table)} AS table", "m.*"
    )


@dataclass(frozen=True)
class Parity:
    """Metrics of both sides, the tables that could not be read, and the decimals kept."""

    source: DataFrame
    target: DataFrame
    errors: dict[str, str]
    decimals: int = 10


def _said(error: Exception) -> str:
    text = error.args[0] if isinstance(error, KeyError) else str(error)
    return text.strip().splitlines()[0][:ERROR_LENGTH]


def run_parity(
    spark: SparkSession, spec: Spec, source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]
) -> Parity:
    """Metrics of every table of the spec, measured now.

    What fails for a table, when its plan is built or while it runs, becomes that
    table's error; the others are compared all the same. What comes to the driver is
    a row for each declared metric.
    """
    decimals = places(spec)
    plans, errors = {}, {}
    for table, measures in spec.items():
        try:
            sides = []
            for name, tables in (("source", source), ("target", target)):
                if table not in tables:
                    raise KeyError(f"{name} has no table {table}")
                sides.append(parity_metrics(table, measures, tables[table], decimals).withColumn("side", F.lit(name)))
            plans[table] = sides[0].unionByName(sides[1])
        except (PySparkException, KeyError) as error:
            errors[table] = _said(error)
    found = []
    try:
        found = reduce(DataFrame.unionByName, plans.values()).collect() if plans else []
    except (PySparkException, Py4JError):  # some table fails: one by one
        for table, plan in plans.items():
            try:
                found += plan.collect()
            except (PySparkException, Py4JError) as error:
                errors[table] = _said(error)
    schema = f"table STRING, metric STRING, number DECIMAL(38,{decimals}), text STRING, side STRING"
    metrics = spark.createDataFrame(found, schema)
    both = [metrics.where(F.col("side") == name).drop("side") for name in ("source", "target")]
    return Parity(*both, errors, decimals)


def _compared(parity: Parity, tolerance: Decimal) -> DataFrame:
    """Every metric with both values, the delta of numbers, and whether it differs."""
    s = parity.source.selectExpr("table", "metric", "number AS s_number", "text AS s_text")
    t = parity.target.selectExpr("table", "metric", "number AS t_number", "text AS t_text")
    return (
        s.join(t, ["table", "metric"], "full_outer")
        .selectExpr(
            "table",
            "metric",
            "coalesce(s_text, 'NULL') AS source",
            "coalesce(t_text, 'NULL') AS target",
            f"CAST(abs(s_number - t_number) AS DECIMAL(38,{parity.decimals})) AS distance",
        )
        .selectExpr("*", f"CASE WHEN distance IS NULL THEN source <> target ELSE distance > {tolerance:f}BD END AS differs")
        .selectExpr(
            "table", "metric", "source", "target",
            f"CASE WHEN differs AND distance IS NOT NULL THEN {_plain('distance')} ELSE '' END AS delta",
            "differs",
        )
    )


def parity_diff(parity: Parity, tolerance: Decimal = DEFAULT_TOLERANCE) -> DataFrame:
    """The metrics that differ. Numbers may differ by the tolerance, text by trailing blanks."""
    return _compared(parity, tolerance).where("differs").drop("differs")


def parity_report(parity: Parity, tolerance: Decimal = DEFAULT_TOLERANCE) -> DataFrame:
    """One row per table: rows on both sides, metrics compared, mismatches, error."""
    compared = (
        _compared(parity, tolerance)
        .groupBy("table")
        .agg(
            F.expr("CAST(max(CASE WHEN metric = 'row_count' THEN source END) AS BIGINT)").alias("source_rows"),
            F.expr("CAST(max(CASE WHEN metric = 'row_count' THEN target END) AS BIGINT)").alias("target_rows"),
            rows().alias("metrics_compared"),
            F.expr("count_if(differs)").alias("mismatches"),
            F.lit("").alias("error"),
        )
    )
    if parity.errors:
        failed = compared.sparkSession.createDataFrame(
            [(t, 0, 0, 0, 0, e) for t, e in parity.errors.items()], compared.schema
        )
        compared = compared.unionByName(failed)
    return compared.withColumn("matched", F.expr("mismatches = 0 AND error = ''"))


def parity_ok(report: DataFrame) -> DataFrame:
    """Overall outcome: one row; a report without tables is ok."""
    return report.agg(
        F.expr("count_if(matched)").alias("matched"),
        F.expr("count_if(error <> '')").alias("errored"),
        rows().alias("tables"),
    ).withColumn("ok", F.expr("matched = tables"))
