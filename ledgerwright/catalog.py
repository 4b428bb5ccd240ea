"""Planning tables, views and functions under their SQL names, for one session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerwright.functions.exprs import quoted
from ledgerwright.functions.stored import materialize
from ledgerwright.operators.allocation import allocation_rule_targets
from ledgerwright.operators.hierarchy import cost_center_explode, cost_center_path
from ledgerwright.operators.reports import budget_consolidation_summary

SUMMARY_VIEW = "vw_BudgetConsolidationSummary"
TARGETS_VIEW = "vw_AllocationRuleTargets"
#: The hierarchy is walked once, at registration; the functions look it up.
PATHS = "CostCenterPath"
CLOSURE = "CostCenterClosure"

_FUNCTIONS = (
    f"""fn_GetHierarchyPath(cost_center_id BIGINT) RETURNS STRING
        RETURN (SELECT max(path) FROM {PATHS} WHERE CostCenterID = cost_center_id)""",
    """fn_GetAllocationFactor(source_id BIGINT, target_id BIGINT, basis STRING, period_id BIGINT, header_id BIGINT)
        RETURNS DECIMAL(18,10)
        RETURN CASE basis
            WHEN 'EQUAL' THEN CAST(try_divide(CAST(1 AS DECIMAL(18,10)), CAST((
                SELECT count(DISTINCT CostCenterID) FROM BudgetLineItem
                WHERE BudgetHeaderID = header_id AND FiscalPeriodID = period_id) AS DECIMAL(19,0))) AS DECIMAL(18,10))
            WHEN 'HEADCOUNT' THEN coalesce((
                SELECT max(AllocationWeight) FROM CostCenter WHERE CostCenterID = target_id), 1)
            ELSE 1 END""",
    f"""tvf_ExplodeCostCenterHierarchy(root_id BIGINT)
        RETURNS TABLE (CostCenterID BIGINT, CostCenterCode STRING, CostCenterName STRING, ParentCostCenterID BIGINT,
                       HierarchyLevel INT, HierarchyPath STRING)
        RETURN SELECT CostCenterID, CostCenterCode, CostCenterName, ParentCostCenterID, HierarchyLevel, HierarchyPath
               FROM {CLOSURE} WHERE RootCostCenterID = root_id""",
    """tvf_GetBudgetVariance(header_id BIGINT, period_id BIGINT)
        RETURNS TABLE (GLAccountID BIGINT, CostCenterID BIGINT, OriginalAmount DECIMAL(19,4),
                       AdjustedAmount DECIMAL(19,4), FinalAmount DECIMAL(19,4), VarianceAmount DECIMAL(19,4),
                       VariancePercent DECIMAL(10,2))
        RETURN SELECT GLAccountID, CostCenterID, OriginalAmount, AdjustedAmount, FinalAmount, AdjustedAmount,
                      CAST(CASE WHEN OriginalAmount = 0 THEN 0 ELSE AdjustedAmount / OriginalAmount * 100 END
                           AS DECIMAL(10,2))
               FROM BudgetLineItem
               WHERE BudgetHeaderID = header_id AND FiscalPeriodID = period_id AND AdjustedAmount <> 0""",
)


def register(spark: SparkSession, tables: Mapping[str, DataFrame], now: str) -> None:
    """Make the tables, both views and the functions available to ``spark.sql``.

    The two hierarchy functions read paths and the closure as they are now; call
    ``refresh_hierarchy`` after ``CostCenter`` changes. All else follows the tables.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    budget_consolidation_summary(
        tables["BudgetLineItem"], tables["BudgetHeader"], tables["GLAccount"], tables["CostCenter"],
        tables["FiscalPeriod"],
    ).createOrReplaceTempView(SUMMARY_VIEW)
    allocation_rule_targets(tables["AllocationRule"], tables["CostCenter"], now).createOrReplaceTempView(TARGETS_VIEW)
    refresh_hierarchy(tables["CostCenter"])
    for definition in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")


def refresh_hierarchy(centers: DataFrame) -> None:
    """Store paths and closure of the cost centers anew for the hierarchy functions."""
    materialize(cost_center_path(centers), "paths").createOrReplaceTempView(PATHS)
    materialize(cost_center_explode(centers), "closure").createOrReplaceTempView(CLOSURE)


def object_inventory(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row per kind of object found in the session's catalog."""
    names = {v["viewName"].lower() for v in spark.sql("SHOW VIEWS").collect()}
    functions = {f["function"].rsplit(".", 1)[-1].lower() for f in spark.sql("SHOW USER FUNCTIONS").collect()}
    wanted = {
        "Tables": names & {t.lower() for t in tables},
        "Views": names & {SUMMARY_VIEW.lower(), TARGETS_VIEW.lower()},
        "Functions": functions & {d.split("(", 1)[0].lower() for d in _FUNCTIONS},
    }
    rows = [f"{kind} Created ({len(found)})" if found else f"No {kind}" for kind, found in wanted.items()]
    return spark.sql("SELECT inline(array(" + ", ".join(f"struct({quoted(r)} AS Status)" for r in rows) + "))")
