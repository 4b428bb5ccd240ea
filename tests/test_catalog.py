from decimal import Decimal

from sample_ledger import NOW, value

from ledgerwright import catalog


def test_sql_surface(spark, sample):
    catalog.register(spark, sample, NOW)
    assert {r.Status for r in catalog.object_inventory(spark, sample).collect()} == {
        "Tables Created (6)", "Views Created (2)", "Functions Created (4)"}
    assert value(spark.sql("SELECT count(*) FROM vw_BudgetConsolidationSummary")) == 250
    assert value(spark.sql("SELECT count(*) FROM vw_AllocationRuleTargets")) == 3
    assert value(spark.sql("SELECT fn_GetHierarchyPath(4)")) == "CORP/OPS/SALES/SALES-N"
    assert value(spark.sql("SELECT fn_GetHierarchyPath(400)")) is None
    factors = spark.sql("""SELECT fn_GetAllocationFactor(1, 3, 'HEADCOUNT', 1, 1),
        fn_GetAllocationFactor(1, 400, 'HEADCOUNT', 1, 1), fn_GetAllocationFactor(1, 3, 'EQUAL', 15, 1),
        fn_GetAllocationFactor(1, 3, 'OTHER', 1, 1)""").first()
    assert tuple(factors) == (Decimal("0.4"), 1, None, 1)
    rows = spark.sql("SELECT CostCenterCode, HierarchyLevel FROM tvf_ExplodeCostCenterHierarchy(7)").collect()
    assert {tuple(r) for r in rows} == {("FIN", 0), ("ACC", 1), ("FP", 1)}
    lines = sample["BudgetLineItem"].where("FiscalPeriodID = 4 AND AdjustedAmount <> 0").count()
    assert value(spark.sql("SELECT count(*) FROM tvf_GetBudgetVariance(1, 4)")) == lines
