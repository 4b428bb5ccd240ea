"""Views and reports over the ledger.

Joins carry no broadcast hints: Spark broadcasts a side whose measured size is
below its threshold and shuffles it otherwise, splitting skewed partitions.
The ledger is reduced to the join keys before it meets a dimension.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import rows, total, total_or_zero
from ledgerwright.schemas import NATURAL_KEY, TOTAL

#: Account type -> category.
CATEGORIES = {"R": "Revenue", "X": "Expense", "A": "Asset", "L": "Liability", "E": "Equity"}

FIRST_LINES = 10


def _copies(df: DataFrame, columns: list[str], weight: str) -> DataFrame:
    """Distinct attribute rows with the number of copies of each."""
    return df.groupBy(*columns).agg(rows().alias(weight))


def budget_consolidation_summary(
    ledger: DataFrame, headers: DataFrame, accounts: DataFrame, centers: DataFrame, periods: DataFrame
) -> DataFrame:
    """Ledger totals by budget, period, account and cost center.

    The ledger is summed by its four ids first; nothing is regrouped after the
    joins. Ids are not enforced to be unique, so each dimension brings the number
    of its equal rows and the totals are multiplied by it, as the joins would.
    """
    facts = ledger.groupBy(*NATURAL_KEY).agg(
        total("OriginalAmount").alias("original"),
        total("AdjustedAmount").alias("adjusted"),
        total("OriginalAmount + AdjustedAmount").alias("final"),
        total("coalesce(LocalCurrencyAmount, 0)").alias("local"),
        total("coalesce(ReportingCurrencyAmount, 0)").alias("reporting"),
        rows().alias("lines"),
    )
    account_columns = ["GLAccountID", "AccountNumber", "AccountName", "AccountType"]
    center_columns = ["CostCenterID", "CostCenterCode", "CostCenterName", "ParentCostCenterID"]
    header_columns = ["BudgetHeaderID", "BudgetCode", "BudgetName", "BudgetType", "ScenarioType", "FiscalYear"]
    period_columns = ["FiscalPeriodID", "FiscalQuarter", "FiscalMonth", "PeriodName"]
    joined = (
        facts.join(_copies(accounts, account_columns, "w1"), "GLAccountID")
        .join(_copies(centers, center_columns, "w2"), "CostCenterID")
        .join(_copies(headers, header_columns, "w3"), "BudgetHeaderID")
        .join(_copies(periods, period_columns, "w4"), "FiscalPeriodID")
    )

    def scaled(column: str) -> str:
        # the usual weight of 1 needs no decimal product
        return f"CASE WHEN weight = 1 THEN {column} ELSE CAST({column} * weight AS {TOTAL.simpleString()}) END"

    return joined.selectExpr("*", "w1 * w2 * w3 * w4 AS weight").selectExpr(
        *header_columns,
        *period_columns,
        *account_columns,
        *center_columns,
        f"{scaled('original')} AS TotalOriginalAmount",
        f"{scaled('adjusted')} AS TotalAdjustedAmount",
        f"{scaled('final')} AS TotalFinalAmount",
        f"{scaled('local')} AS TotalLocalCurrency",
        f"{scaled('reporting')} AS TotalReportingCurrency",
        "lines * weight AS LineItemCount",
    )


def budget_variance(ledger: DataFrame) -> DataFrame:
    """Lines with an adjustment, and the adjustment in percent of the original."""
    return ledger.where("AdjustedAmount <> 0").selectExpr(
        "BudgetHeaderID",
        "FiscalPeriodID",
        "GLAccountID",
        "CostCenterID",
        "OriginalAmount",
        "AdjustedAmount",
        "FinalAmount",
        "AdjustedAmount AS VarianceAmount",
        """CAST(CASE WHEN OriginalAmount <> 0 THEN AdjustedAmount / OriginalAmount * 100 ELSE 0 END
           AS DECIMAL(10,2)) AS VariancePercent""",
    )


def table_counts(tables: dict[str, DataFrame], labels: dict[str, str] | None = None) -> DataFrame:
    """Row count per table, in name order."""
    counts = [
        df.agg(rows().alias("RecordCount")).select(
            F.lit((labels or {}).get(name, name)).alias("TableName"), "RecordCount"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("TableName")


def budget_line_sample(
    ledger: DataFrame, headers: DataFrame, accounts: DataFrame, centers: DataFrame, lines: int = FIRST_LINES
) -> DataFrame:
    """The first lines by id, with the names of their dimensions.

    Lines without one of the dimensions are left out before the limit; repeated
    dimension rows then repeat lines, so the limit holds again after the joins.
    """
    dimensions = (
        (headers, "BudgetHeaderID", ["BudgetCode", "BudgetName"]),
        (accounts, "GLAccountID", ["AccountNumber", "AccountName"]),
        (centers, "CostCenterID", ["CostCenterCode", "CostCenterName"]),
    )
    first = ledger
    for dimension, key, _ in dimensions:
        first = first.join(dimension.select(key), key, "left_semi")
    first = first.orderBy("BudgetLineItemID").limit(lines)
    for dimension, key, names in dimensions:
        first = first.join(dimension.select(key, *names), key)
    return (
        first.orderBy("BudgetLineItemID")
        .limit(lines)
        .select(*[n for _, _, names in dimensions for n in names], "OriginalAmount", "AdjustedAmount", "FinalAmount")
    )


def budget_analysis(ledger: DataFrame, headers: DataFrame, budget_code: str | None = None) -> DataFrame:
    """Totals per budget and the ratio of final to original amount."""
    if budget_code is not None:
        headers = headers.where(F.col("BudgetCode") == budget_code)
    by_period = ledger.groupBy("BudgetHeaderID", "FiscalPeriodID").agg(
        total("OriginalAmount").alias("original"),
        total("AdjustedAmount").alias("adjusted"),
        total("FinalAmount").alias("final"),
        rows().alias("lines"),
    )
    sums = (
        by_period.join(headers.select("BudgetHeaderID", "BudgetCode", "BudgetName"), "BudgetHeaderID")
        .groupBy("BudgetCode", "BudgetName")
        .agg(
            F.count_distinct("FiscalPeriodID").alias("PeriodsIncluded"),
            F.sum("lines").alias("LineItemCount"),
            total("original").alias("TotalOriginal"),
            total("adjusted").alias("TotalAdjusted"),
            total("final").alias("TotalFinal"),
        )
    )
    ratio = F.expr("CAST(round(TotalFinal / nullif(TotalOriginal, 0), 4) AS DECIMAL(19,4))")
    return sums.withColumn("FinalToOriginalRatio", ratio)


def cost_center_summary(centers: DataFrame, ledger: DataFrame) -> DataFrame:
    """Lines and total per active cost center, with its parent's code.

    Ids are not enforced. A repeated center or parent repeats its lines in the total,
    as the joins would, but a line counts once for each code, name and parent: ids are
    reduced to those of a group with the number of their repetitions first.
    """
    group = ["CostCenterCode", "CostCenterName", "parent"]
    booked = ledger.groupBy("CostCenterID").agg(
        F.count_distinct("BudgetLineItemID").alias("lines"),
        total("FinalAmount").alias("final"),
    )
    parents = centers.select(
        F.col("CostCenterID").alias("ParentCostCenterID"), F.col("CostCenterCode").alias("parent")
    )
    named = (
        centers.where("IsActive")
        .select("CostCenterID", "CostCenterCode", "CostCenterName", "ParentCostCenterID")
        .join(parents, "ParentCostCenterID", "left")
        .groupBy(*group, "CostCenterID")
        .agg(rows().alias("times"))
    )
    return (
        named.join(booked, "CostCenterID", "left")
        .groupBy(*group)
        .agg(
            F.coalesce(F.sum("lines"), F.lit(0)).alias("BudgetLineCount"),
            total("CASE WHEN times = 1 THEN final ELSE final * times END").alias("TotalBudgetAmount"),
        )
        .select(
            "CostCenterCode",
            "CostCenterName",
            F.coalesce("parent", F.lit("ROOT")).alias("ParentCode"),
            "BudgetLineCount",
            "TotalBudgetAmount",
        )
    )


def _category() -> str:
    names = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in CATEGORIES.items())
    return f"CASE AccountType {names} END"


def gl_account_distribution(
    accounts: DataFrame, headers: DataFrame, ledger: DataFrame, budget_code: str | None = None
) -> DataFrame:
    """Per budget and account category: joined rows, budgeted rows and total.

    An account counts once per ledger line it has in the budget, and once if it
    has none. That is the number of accounts, plus the lines, minus the
    accounts that have lines, so accounts are never multiplied by budgets.
    """
    active = accounts.where("IsActive").selectExpr("GLAccountID", f"{_category()} AS AccountCategory")
    booked = ledger.groupBy("BudgetHeaderID", "GLAccountID").agg(
        rows().alias("lines"), total("FinalAmount").alias("final")
    )
    per_budget = (
        booked.join(active, "GLAccountID")
        .groupBy("BudgetHeaderID", "AccountCategory")
        .agg(F.sum("lines").alias("lines"), rows().alias("touched"), total("final").alias("final"))
    )
    if budget_code is None:
        codes = headers.select("BudgetCode", "BudgetHeaderID")
    else:
        # a code without a header still lists the accounts, all without lines
        codes = (
            headers.sparkSession.range(1)
            .select(F.lit(budget_code).alias("BudgetCode"))
            .join(headers.select("BudgetCode", "BudgetHeaderID"), "BudgetCode", "left")
        )
    every = F.expr("explode(array(" + ", ".join(f"'{c}'" for c in CATEGORIES.values()) + ", NULL))")
    per_category = active.groupBy("AccountCategory").agg(rows().alias("accounts"))
    grid = (
        codes.withColumn("slot", every)
        .join(per_category.withColumnRenamed("AccountCategory", "own"), F.col("slot").eqNullSafe(F.col("own")))
        .drop("own")
    )
    per_budget = per_budget.withColumnRenamed("BudgetHeaderID", "budget")
    return (
        grid.join(
            per_budget,
            (F.col("BudgetHeaderID") == F.col("budget")) & F.col("slot").eqNullSafe(F.col("AccountCategory")),
            "left",
        )
        .groupBy("BudgetCode", "slot")
        .agg(
            F.expr("sum(accounts + coalesce(lines - touched, 0))").alias("AccountCount"),
            F.expr("sum(coalesce(lines, 0))").alias("BudgetedAccounts"),
            total_or_zero("final").alias("TotalBudgetAmount"),
        )
        .withColumnRenamed("slot", "AccountCategory")
    )
