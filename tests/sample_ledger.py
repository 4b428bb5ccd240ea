"""A small planning dataset with known answers.

Fixed values: the periods, accounts, cost centers and rules of the sample
ledger. Amounts are repeatable arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwright import schemas as S
from ledgerwright.operators.generate import budget_grid
from ledgerwright.operators.period import budget_header_bounds

NOW = "2024-06-01 12:00:00"

# type, first number, accounts, normal balance, budgetable; numbers go up by 100
KINDS = [
    ("R", 4000, 5, "C", True),
    ("X", 5000, 9, "D", True),
    ("A", 1000, 3, "D", False),
    ("L", 2000, 2, "C", False),
    ("E", 3000, 1, "C", False),
]
# number, name, type, postable, budgetable, normal balance, intercompany: the last
# budgetable account of a type is for intercompany lines, equity is not posted to
ACCOUNTS = [
    (str(first + 100 * k), f"{kind} account {k}", kind, kind != "E", budgetable, balance, budgetable and k == n - 1)
    for kind, first, n, balance, budgetable in KINDS
    for k in range(n)
]

# code, name, parent, weight
CENTERS = [
    ("CORP", "whole company", None, "1"),
    ("OPS", "works", 1, "0.9"),
    ("SALES", "shops", 2, "0.4"),
    ("SALES-N", "shops up north", 3, "0.25"),
    ("LAB", "test bench", 3, "0.15"),
    ("YARD", "stores and vans", 2, "0.6"),
    ("FIN", "money", 1, "0.8"),
    ("ACC", "books", 7, "0.45"),
    ("FP", "plans", 7, "0.35"),
    ("HR", "people", 1, "1"),
    ("LEGAL", "contracts", 1, "0.7"),
]

# code, method and basis, source, targets, sequence
RULES = [
    ("SPLIT-A", "HEADCOUNT", 1, '{"targetCostCenters": ["OPS", "FIN"]}', 10),
    ("SPLIT-B", "EQUAL", 7, '{"targetCostCenters": ["ACC", "FP"]}', 30),
    ("SPLIT-C", "REVENUE", 2, '{"targetCostCenters": ["SALES", "YARD"]}', 20),
]


def periods(spark: SparkSession) -> DataFrame:
    months = [(i + 1, 2024 + i // 12, i % 12 + 1) for i in range(15)]
    df = spark.createDataFrame(months, "FiscalPeriodID bigint, FiscalYear int, FiscalMonth int").selectExpr(
        "*",
        "CAST((FiscalMonth + 2) DIV 3 AS INT) AS FiscalQuarter",
        "date_format(make_date(FiscalYear, FiscalMonth, 1), 'MMMM yyyy') AS PeriodName",
        "make_date(FiscalYear, FiscalMonth, 1) AS PeriodStartDate",
        "last_day(make_date(FiscalYear, FiscalMonth, 1)) AS PeriodEndDate",
    )
    return S.complete(df, S.FISCAL_PERIOD, NOW)


def accounts(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(
        [(i, *a) for i, a in enumerate(ACCOUNTS, 1)],
        "GLAccountID bigint, AccountNumber string, AccountName string, AccountType string, IsPostable boolean,"
        " IsBudgetable boolean, NormalBalance string, IntercompanyFlag boolean",
    )
    return S.complete(df, S.GL_ACCOUNT, NOW)


def centers(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(CENTERS, 1)],
        "CostCenterID bigint, CostCenterCode string, CostCenterName string, ParentCostCenterID bigint, w string",
    ).selectExpr(
        "*", "CAST(w AS DECIMAL(5,4)) AS AllocationWeight", "DATE'2024-01-01' AS EffectiveFromDate", "true AS IsActive"
    )
    return S.complete(df, S.COST_CENTER, NOW)


def rules(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(
        [(i, code, code, "DIRECT", method, source, spec, method, n)
         for i, (code, method, source, spec, n) in enumerate(RULES, 1)],
        "AllocationRuleID bigint, RuleCode string, RuleName string, RuleType string, AllocationMethod string,"
        " SourceCostCenterID bigint, TargetSpecification string, AllocationBasis string, ExecutionSequence int",
    ).selectExpr("*", "DATE'2024-01-01' AS EffectiveFromDate", "true AS IsActive")
    return S.complete(df, S.ALLOCATION_RULE, NOW)


def headers(periods_: DataFrame) -> DataFrame:
    planned = budget_header_bounds(periods_).where("FiscalYear = 2024")
    return S.complete(
        planned.selectExpr("*", "CAST(right(BudgetCode, 3) AS BIGINT) AS BudgetHeaderID"), S.BUDGET_HEADER, NOW
    )


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The dataset, built once and cached: 250 ledger lines in budget 1."""
    out = {
        "FiscalPeriod": periods(spark),
        "GLAccount": accounts(spark),
        "CostCenter": centers(spark),
        "AllocationRule": rules(spark),
    }
    out["BudgetHeader"] = headers(out["FiscalPeriod"])
    grid = budget_grid(
        out["BudgetHeader"].where("BudgetHeaderID = 1"), out["GLAccount"], out["CostCenter"], out["FiscalPeriod"]
    )
    numbered = grid.selectExpr(
        "CAST(((BudgetHeaderID * 100 + FiscalPeriodID) * 100 + GLAccountID) * 100 + CostCenterID AS BIGINT)"
        " AS BudgetLineItemID",
        "*",
    )
    out["BudgetLineItem"] = S.complete(numbered, S.BUDGET_LINE_ITEM, NOW)
    return {name: df.cache() for name, df in out.items()}


def value(df: DataFrame):
    """The single value of a one-row, one-column result."""
    return df.first()[0]


def line_count(df: DataFrame, header: int = 1) -> int:
    return df.where(F.col("BudgetHeaderID") == header).count()
