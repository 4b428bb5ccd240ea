"""Period close, intercompany extraction, rolling forecast, budget bounds, cleanup."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwright.functions.exprs import ZERO, quoted, rows, stamp, total

#: Amount per forecast period, and the range of forecast lengths.
FORECAST_AMOUNT = 100000
FORECAST_MONTHS = range(1, 61)
#: Scenario, its budget type, code suffix, name and first month.
SCENARIOS = (
    ("BASE", "ANNUAL", "001", "Annual Budget - Base Case", 1),
    ("OPTIMISTIC", "ROLLING", "002", "Rolling Forecast - Optimistic", 2),
    ("PESSIMISTIC", "ROLLING", "003", "Rolling Forecast - Conservative", 3),
)


def period_set(periods: DataFrame, ids: list[int | None]) -> DataFrame:
    """The requested period ids as a one-column DataFrame; a missing id is an error."""
    if not ids or any(i is None for i in ids):
        raise ValueError("Fiscal period ID is required")
    return periods.sparkSession.createDataFrame([(i,) for i in ids], "FiscalPeriodID bigint")


def _flagged(df: DataFrame, closing: DataFrame) -> DataFrame:
    keys = closing.select("FiscalPeriodID").distinct().withColumn("_closing", F.lit(True))
    return df.join(keys, "FiscalPeriodID", "left").withColumn("_closing", F.expr("coalesce(_closing, false)"))


def close_period(periods: DataFrame, closing: DataFrame, now: str) -> DataFrame:
    """The period table with the given periods closed. Unknown ids change nothing."""
    changed = {
        "IsClosed": "_closing OR IsClosed AS IsClosed",
        "ClosedDateTime": f"CASE WHEN _closing THEN {stamp(now)} ELSE ClosedDateTime END AS ClosedDateTime",
    }
    return _flagged(periods, closing).selectExpr(*[changed.get(c, c) for c in periods.columns])


def close_lines(ledger: DataFrame, closing: DataFrame) -> DataFrame:
    """The ledger with every line of the given periods marked allocated."""
    changed = {"IsAllocated": "_closing OR IsAllocated AS IsAllocated"}
    return _flagged(ledger, closing).selectExpr(*[changed.get(c, c) for c in ledger.columns])


def close_result(closing: DataFrame, now: str, level: str = "PERIOD") -> DataFrame:
    """One result row per requested period."""
    return closing.selectExpr(
        "'SUCCESS' AS status",
        f"{stamp(now)} AS close_start",
        f"{stamp(now)} AS close_end",
        "FiscalPeriodID AS period_id",
        f"{quoted(level)} AS close_level",
    )


def intercompany_items(ledger: DataFrame, accounts: DataFrame, centers: DataFrame) -> DataFrame:
    """Lines on intercompany accounts with a known cost center, all unmatched."""
    return (
        ledger.select("BudgetLineItemID", "CostCenterID", "GLAccountID", "FiscalPeriodID", "FinalAmount")
        .join(accounts.where("IntercompanyFlag").select("GLAccountID"), "GLAccountID")
        .join(centers.select("CostCenterID"), "CostCenterID")
        .withColumn("status", F.lit("UNMATCHED"))
    )


def intercompany_result(items: DataFrame, periods: DataFrame, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """Items per requested period. Nothing is matched, so there is no variance."""
    counts = items.groupBy("FiscalPeriodID").agg(rows().alias("found"))
    return periods.select("FiscalPeriodID").join(counts, "FiscalPeriodID", "left").selectExpr(
        "FiscalPeriodID AS fiscal_period_id",
        f"CAST({tolerance} AS DECIMAL(19,4)) AS tolerance_amount",
        "coalesce(found, 0L) AS reconciled_count",
        "0L AS variance_count",
        f"{ZERO} AS total_variance_amount",
    )


def rolling_forecast(headers: DataFrame, months: int, base_year: str = "FiscalYear", base_month: int = 12) -> DataFrame:
    """The months after each budget's base month, a flat amount each."""
    if months not in FORECAST_MONTHS:
        raise ValueError("Forecast months must be between 1 and 60")
    serial = f"({base_year} * 12 + {base_month - 1} + PeriodNumber)"
    return headers.withColumn("PeriodNumber", F.expr(f"explode(sequence(1, {months}))")).selectExpr(
        "BudgetHeaderID",
        "PeriodNumber",
        f"CAST({serial} DIV 12 AS INT) AS FiscalYear",
        f"CAST({serial} % 12 + 1 AS INT) AS FiscalMonth",
        f"CAST({FORECAST_AMOUNT} AS DECIMAL(19,4)) AS ForecastAmount",
    )


def rolling_forecast_result(forecast: DataFrame, growth_rate_pct: Decimal = Decimal("0")) -> DataFrame:
    return forecast.groupBy("BudgetHeaderID").agg(
        rows().alias("periods_generated"),
        total("ForecastAmount").alias("total_forecast_amount"),
    ).withColumn("growth_rate_pct", F.lit(growth_rate_pct).cast(T.DecimalType(9, 4)))


def budget_header_bounds(periods: DataFrame, last_month: int = 12) -> DataFrame:
    """Three scenario budgets per fiscal year, with their first and last period."""
    def at(month: int) -> str:
        return f"CASE WHEN FiscalMonth = {month} THEN FiscalPeriodID END"

    bounds = periods.groupBy("FiscalYear").agg(
        *[F.expr(f"min({at(first)})").alias(scenario) for scenario, _, _, _, first in SCENARIOS],
        F.expr(f"max({at(last_month)})").alias("last"),
    )
    plans = ", ".join(
        f"""named_struct('BudgetCode', concat('BUDGET-', FiscalYear, '-{suffix}'),
            'BudgetName', concat(FiscalYear, ' {name}'), 'BudgetType', '{kind}', 'ScenarioType', '{scenario}',
            'StartPeriodID', {scenario})"""
        for scenario, kind, suffix, name, _ in SCENARIOS
    )
    return bounds.selectExpr("FiscalYear", "last", f"explode(array({plans})) AS p").selectExpr(
        "p.BudgetCode",
        "p.BudgetName",
        "p.BudgetType",
        "p.ScenarioType",
        "FiscalYear",
        "p.StartPeriodID",
        "last AS EndPeriodID",
        "'DRAFT' AS StatusCode",
        "1 AS VersionNumber",
        "false AS IsLocked",
    )


def _expired(now: str, hours: int) -> str:
    return f"CreatedDateTime < timestampadd(HOUR, {-hours}, {stamp(now)})"


def kept_allocation_results(staged: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """The staging table without results older than ``hours``."""
    return staged.where(f"NOT ({_expired(now, hours)})")


def cleanup_allocation_results(staged: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """How many results the cleanup removes and keeps, with its message."""
    old = F.expr(f"count_if({_expired(now, hours)})")
    return staged.agg(old.alias("deleted"), rows().alias("n")).selectExpr(
        "deleted", "n - deleted AS kept", "concat('Deleted ', deleted, ' old allocation results') AS message"
    )
