"""Allocation rules and factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import stamp
from ledgerwright.operators.hierarchy import elements, field
from ledgerwright.schemas import RATE


def allocation_rule_targets(rules: DataFrame, centers: DataFrame, now: str) -> DataFrame:
    """One row per target of every active rule, with the target's cost center.

    A target names its cost center by id or by code. That OR is split into two
    equi joins, the second without the pairs of the first, so neither side has
    to fit into memory; a target that matches nothing keeps one row. The joins are
    sorted ones: cost centers grow with the data, and stored as columns they take so
    little room that Spark would send them to all tasks by way of the driver.
    """
    targets = elements(rules.where("IsActive"), "TargetSpecification").selectExpr(
        "AllocationRuleID",
        "RuleCode",
        "RuleName",
        "RuleType",
        "AllocationMethod",
        "ExecutionSequence",
        field("CostCenterID", "bigint", "TargetCostCenterID"),
        field("CostCenterCode", "string", "TargetCostCenterCode"),
        field("AllocationPercentage", "decimal(8,6)", "TargetAllocationPct"),
        field("Priority", "int", "TargetPriority"),
        field("AccountFilter", "string"),
        field("ExcludePattern", "string"),
        # a JSON null is a value here: it counts as conditions, but has no text
        "variant_get(value, '$.Conditions') IS NOT NULL AS HasConditions",
        field("Conditions", "string", "ConditionsJson"),
        "EffectiveFromDate",
        "EffectiveToDate",
        "IsActive AS RuleIsActive",
    )
    known = centers.selectExpr(
        "CostCenterID AS found_id",
        "CostCenterCode AS found_code",
        "CostCenterName AS TargetCostCenterName",
        "ParentCostCenterID AS TargetParentCostCenterID",
        "IsActive AS TargetIsActive",
    ).hint("merge")
    by_id = targets.join(known, F.expr("TargetCostCenterID = found_id"), "left")
    by_code = targets.join(
        known,
        F.expr("TargetCostCenterCode = found_code AND (TargetCostCenterID IS NULL OR TargetCostCenterID <> found_id)"),
    )
    codes = known.selectExpr("found_code AS TargetCostCenterCode").hint("merge")
    unmatched = by_id.where("found_id IS NULL").join(codes, "TargetCostCenterCode", "left_anti")
    return (
        by_id.where("found_id IS NOT NULL")
        .unionByName(by_code)
        .unionByName(unmatched)
        .drop("found_id", "found_code")
        .withColumn("ViewGeneratedDateTime", F.expr(stamp(now)))
    )


def allocation_factor(requests: DataFrame, ledger: DataFrame, centers: DataFrame) -> DataFrame:
    """The factor of every request, by its allocation basis.

    EQUAL divides by the cost centers of the budget and period, and is NULL
    where there are none; HEADCOUNT takes the target's weight, 1 by default;
    any other basis gives 1.
    """
    spread = ledger.groupBy("BudgetHeaderID", "FiscalPeriodID").agg(
        F.count_distinct("CostCenterID").alias("spread")
    )
    weights = centers.selectExpr("CostCenterID AS TargetCostCenterID", "AllocationWeight AS weight")
    rate = RATE.simpleString()
    factor = f"""CAST(CASE AllocationBasis
        WHEN 'EQUAL' THEN CAST(try_divide(CAST(1 AS {rate}), CAST(spread AS DECIMAL(19,0))) AS {rate})
        WHEN 'HEADCOUNT' THEN coalesce(weight, 1) ELSE 1 END AS {rate}) AS AllocationFactor"""
    return (
        requests.join(spread, ["BudgetHeaderID", "FiscalPeriodID"], "left")
        .join(weights, "TargetCostCenterID", "left")
        .selectExpr(*requests.columns, factor)
    )
