from decimal import Decimal

import pytest
from sample_ledger import NOW, value

from ledgerwright.operators import allocation, generate, hierarchy, journals, period, reports

RUN = journals.Run(id="00000010" + "0" * 24, now=NOW)


def test_summary_matches_a_plain_join(sample):
    s = sample
    got = reports.budget_consolidation_summary(
        s["BudgetLineItem"], s["BudgetHeader"], s["GLAccount"], s["CostCenter"], s["FiscalPeriod"])
    assert got.count() == s["BudgetLineItem"].count() == 250
    # original + adjusted, which the sample's final amounts do not equal
    want = value(s["BudgetLineItem"].selectExpr("sum(OriginalAmount + AdjustedAmount)"))
    assert value(got.selectExpr("sum(TotalFinalAmount)")) == want
    assert want != value(s["BudgetLineItem"].selectExpr("sum(FinalAmount)"))


def test_summary_multiplies_by_repeated_dimension_rows(sample):
    s = sample
    twice = s["FiscalPeriod"].unionByName(s["FiscalPeriod"])
    got = reports.budget_consolidation_summary(
        s["BudgetLineItem"], s["BudgetHeader"], s["GLAccount"], s["CostCenter"], twice)
    assert value(got.selectExpr("sum(LineItemCount)")) == 500
    assert value(got.selectExpr("sum(TotalOriginalAmount)")) == 2 * value(
        s["BudgetLineItem"].selectExpr("sum(OriginalAmount)"))


def test_variance_rounds_half_up(spark):
    rows = [(Decimal(300), Decimal(200)), (Decimal(0), Decimal(5)), (Decimal(7), Decimal(0)), (Decimal(-300), Decimal(200))]
    ledger = spark.createDataFrame(rows, "OriginalAmount decimal(19,4), AdjustedAmount decimal(19,4)").selectExpr(
        "*", "1 AS BudgetHeaderID", "1 AS FiscalPeriodID", "1 AS GLAccountID", "1 AS CostCenterID",
        "OriginalAmount AS FinalAmount")
    got = {r.OriginalAmount: r.VariancePercent for r in reports.budget_variance(ledger).collect()}
    assert got == {300: Decimal("66.67"), 0: Decimal("0.00"), -300: Decimal("-66.67")}


def test_distribution_against_brute_force(sample):
    s = sample
    lines = [(r.GLAccountID, r.FinalAmount) for r in s["BudgetLineItem"].collect()]
    want = {}
    for a in s["GLAccount"].collect():
        own = [amount for key, amount in lines if key == a.GLAccountID]
        n, booked, total = want.get(a.AccountType, (0, 0, Decimal(0)))
        want[a.AccountType] = (n + max(len(own), 1), booked + len(own), total + sum(own))
    got = reports.gl_account_distribution(s["GLAccount"], s["BudgetHeader"], s["BudgetLineItem"], "BUDGET-2024-001")
    named = {reports.CATEGORIES[k]: v for k, v in want.items()}
    assert {r.AccountCategory: (r.AccountCount, r.BudgetedAccounts, r.TotalBudgetAmount) for r in got.collect()} == named
    none = reports.gl_account_distribution(s["GLAccount"], s["BudgetHeader"], s["BudgetLineItem"], "NO SUCH")
    assert value(none.selectExpr("sum(AccountCount)")) == 20 and value(none.selectExpr("sum(BudgetedAccounts)")) == 0


def test_line_sample_falls_back_to_the_whole_ledger(sample):
    s = sample
    known = s["GLAccount"].where("AccountNumber = '5800'")
    whole = reports.budget_line_sample(s["BudgetLineItem"], s["BudgetHeader"], known, s["CostCenter"], lines=3)
    plain = (
        s["BudgetLineItem"].join(known, "GLAccountID").orderBy("BudgetLineItemID").limit(3).select("FinalAmount").collect())
    assert [r.FinalAmount for r in whole.collect()] == [r.FinalAmount for r in plain]


def test_paths_and_closure(spark, sample):
    paths = {r.literal_path: r.path for r in hierarchy.cost_center_path(sample["CostCenter"]).collect()}
    assert paths["SALES-N"] == "CORP/OPS/SALES/SALES-N" and paths["CORP"] == "CORP" and len(paths) == 11
    asked = spark.createDataFrame([(4,), (99,)], "CostCenterID bigint")
    assert {r.CostCenterID: r.path for r in hierarchy.cost_center_path(sample["CostCenter"], asked).collect()} == {
        4: "CORP/OPS/SALES/SALES-N", 99: None}
    fin = spark.createDataFrame([(7,)], "CostCenterID bigint")
    rows = hierarchy.cost_center_explode(sample["CostCenter"], fin).collect()
    assert {(r.CostCenterCode, r.HierarchyLevel, r.HierarchyPath) for r in rows} == {
        ("FIN", 0, "FIN"), ("ACC", 1, "FIN/ACC"), ("FP", 1, "FIN/FP")}


def test_an_inactive_node_cuts_its_subtree(sample):
    cut = sample["CostCenter"].withColumn("IsActive", sample["CostCenter"].CostCenterCode != "SALES")
    codes = {r.CostCenterCode for r in hierarchy.cost_center_explode(cut).where("RootCostCenterID = 1").collect()}
    assert codes == {"CORP", "OPS", "YARD", "FIN", "ACC", "FP", "HR", "LEGAL"}


def test_depth_is_bounded_on_chains_and_cycles(spark):
    chain = [(i, f"c{i}", i - 1 if i > 1 else None) for i in range(1, 31)]
    cycle = [(101, "a", 102), (102, "b", 101)]
    nodes = spark.createDataFrame(chain + cycle, "CostCenterID bigint, CostCenterCode string, ParentCostCenterID bigint")
    nodes = nodes.selectExpr("*", "CostCenterCode AS CostCenterName", "true AS IsActive")
    paths = {r.CostCenterID: r.path.split("/") for r in hierarchy.cost_center_path(nodes).collect()}
    assert paths[20] == [f"c{i}" for i in range(1, 21)]
    assert paths[30] == [f"c{i}" for i in range(11, 31)]
    assert len(paths[101]) == 20 and paths[101][-2:] == ["b", "a"]
    levels = hierarchy.cost_center_explode(nodes).where("CostCenterID = 30").selectExpr("max(HierarchyLevel)")
    assert value(levels) == 20


def test_rule_targets_of_an_object_and_an_array(spark, sample):
    rules = sample["AllocationRule"]
    targets = allocation.allocation_rule_targets(rules, sample["CostCenter"], NOW).collect()
    assert len(targets) == 3 and all(t.TargetCostCenterID is None and not t.HasConditions for t in targets)
    listed = rules.limit(1).selectExpr(*[
        """'[{"CostCenterID": 2, "CostCenterCode": "FIN", "Conditions": null}, {"CostCenterCode": "HR",
        "AllocationPercentage": 0.5}, {"CostCenterID": 77}, {"CostCenterID": 3, "CostCenterCode": "SALES"}]'
        AS TargetSpecification""" if c == "TargetSpecification" else c for c in rules.columns])
    rows = allocation.allocation_rule_targets(listed, sample["CostCenter"], NOW).collect()
    got = sorted((t.TargetCostCenterID or 0, t.TargetCostCenterName or "", t.HasConditions) for t in rows)
    assert got == [(0, "people", False), (2, "money", True), (2, "works", True),
                   (3, "shops", False), (77, "", False)]


def test_allocation_factor(spark, sample):
    requests = spark.createDataFrame(
        [(1, 1, 3, "EQUAL", 1, 1), (2, 1, 3, "HEADCOUNT", 1, 1), (3, 1, 99, "HEADCOUNT", 1, 1),
         (4, 1, 3, "REVENUE", 1, 1), (5, 1, 3, "EQUAL", 15, 1)],
        "request_id int, SourceCostCenterID bigint, TargetCostCenterID bigint, AllocationBasis string,"
        " FiscalPeriodID bigint, BudgetHeaderID bigint")
    got = {r.request_id: r.AllocationFactor for r in allocation.allocation_factor(
        requests, sample["BudgetLineItem"], sample["CostCenter"]).collect()}
    spread = sample["BudgetLineItem"].where("FiscalPeriodID = 1").select("CostCenterID").distinct().count()
    assert got[1] == round(Decimal(1) / spread, 10)
    assert (got[2], got[3], got[4], got[5]) == (Decimal("0.4"), 1, 1, None)


def test_allocation_journal(spark, sample):
    headers = journals.requested_headers(
        sample["BudgetHeader"], spark.createDataFrame([(1,)], "BudgetHeaderID bigint"))
    journal = journals.cost_allocation_journal(headers, RUN)
    head = journal.first()
    assert head.JournalNumber == "ALLOC-20240601120000-00000011"
    lines = journals.cost_allocation_lines(sample["BudgetLineItem"], journal, RUN).cache()
    result = journals.cost_allocation_result(headers, sample["BudgetLineItem"], sample["AllocationRule"], RUN).first()
    assert lines.count() == 250 and result.rules_processed == 3
    assert [r.LineNumber for r in lines.orderBy("LineNumber").collect()] == list(range(1, 251))
    assert value(lines.selectExpr("sum(NetAmount)")) == result.total_allocated
    dry = journals.cost_allocation_result(
        headers, sample["BudgetLineItem"], sample["AllocationRule"], RUN, dry_run=True).first()
    assert (dry.total_allocated, dry.journal_id, dry.journal_number, dry.dry_run) == (0, None, None, True)


def test_consolidation_keeps_active_centers(spark, sample):
    centers = sample["CostCenter"].withColumn("IsActive", sample["CostCenter"].CostCenterCode != "HR")
    headers = sample["BudgetHeader"].where("BudgetHeaderID = 1")
    journal = journals.consolidation_journal(headers, RUN)
    lines = journals.consolidation_lines(sample["BudgetLineItem"], centers, journal, RUN)
    result = journals.consolidation_result(headers, sample["BudgetLineItem"], centers, RUN).first()
    expected = sample["BudgetLineItem"].where("CostCenterID <> 10").count()
    assert lines.count() == result.consolidated_lines == expected < 250
    assert result.eliminated_amount == 0


def test_unknown_and_missing_headers_raise(spark, sample):
    for bad, message in ((99, "not found"), (None, "required")):
        asked = spark.createDataFrame([(bad,)], "BudgetHeaderID bigint")
        with pytest.raises(Exception, match=message):
            journals.requested_headers(sample["BudgetHeader"], asked).collect()


def test_forecast(sample):
    headers = sample["BudgetHeader"].where("BudgetHeaderID = 1")
    forecast = period.rolling_forecast(headers, 12, base_month=11)
    assert [(r.FiscalYear, r.FiscalMonth) for r in forecast.orderBy("PeriodNumber").collect()][:3] == [
        (2024, 12), (2025, 1), (2025, 2)]
    result = period.rolling_forecast_result(forecast).first()
    assert (result.periods_generated, result.total_forecast_amount) == (12, 1200000)
    for months in (0, 61):
        with pytest.raises(ValueError, match="between 1 and 60"):
            period.rolling_forecast(headers, months)


def test_close(sample):
    closing = period.period_set(sample["FiscalPeriod"], [1, 404])
    closed = period.close_period(sample["FiscalPeriod"], closing, NOW)
    assert [r.FiscalPeriodID for r in closed.where("IsClosed").collect()] == [1]
    lines = period.close_lines(sample["BudgetLineItem"], closing)
    assert lines.where("FiscalPeriodID = 1 AND NOT IsAllocated").isEmpty()
    assert lines.where("FiscalPeriodID <> 1 AND IsAllocated").isEmpty() and lines.count() == 250
    assert period.close_result(closing, NOW).count() == 2
    with pytest.raises(ValueError, match="required"):
        period.period_set(sample["FiscalPeriod"], [None])


def test_intercompany(sample):
    items = period.intercompany_items(sample["BudgetLineItem"], sample["GLAccount"], sample["CostCenter"])
    result = period.intercompany_result(items, sample["FiscalPeriod"])
    expected = sample["BudgetLineItem"].where("GLAccountID IN (5, 14)").groupBy("FiscalPeriodID").count().collect()
    got = {r.fiscal_period_id: r.reconciled_count for r in result.collect()}
    assert len(got) == 15 and {k: v for k, v in got.items() if v} == {r.FiscalPeriodID: r["count"] for r in expected}


def test_cleanup(spark):
    staged = spark.createDataFrame([("2024-05-31 11:59:59",), ("2024-05-31 12:00:00",)], "t string").selectExpr(
        "CAST(t AS TIMESTAMP_NTZ) AS CreatedDateTime")
    assert period.cleanup_allocation_results(staged, NOW).first().message == "Deleted 1 old allocation results"
    assert period.kept_allocation_results(staged, NOW).count() == 1


def test_hierarchy_nodes(spark):
    docs = spark.createDataFrame(
        [('[{"NodeID": 1, "NodeLevel": 0, "NodePath": "A", "SortOrder": 1, "IsLeaf": false, "AggregationWeight": 1},'
          ' {"NodeID": "2", "ParentNodeID": 1, "IsLeaf": "true", "AggregationWeight": 0.25}]',), (None,)],
        "payload string")
    nodes = hierarchy.hierarchy_nodes(docs).collect()
    assert [(n.NodeID, n.ParentNodeID, n.IsLeaf, n.AggregationWeight) for n in nodes] == [
        (1, None, False, Decimal(1)), (2, 1, True, Decimal("0.25"))]


def test_generated_cells_are_distinct(sample):
    grid = sample["BudgetLineItem"]
    assert grid.select("BudgetHeaderID", "GLAccountID", "CostCenterID", "FiscalPeriodID").distinct().count() == 250
    bounds = grid.join(sample["GLAccount"], "GLAccountID").groupBy("AccountType").agg(
        {"OriginalAmount": "max", "*": "count"}).collect()
    assert {r.AccountType for r in bounds} == {"R", "X"}
    small = generate.budget_grid(
        sample["BudgetHeader"].where("BudgetHeaderID = 1"), sample["GLAccount"].where("GLAccountID <= 2"),
        sample["CostCenter"].where("CostCenterID <= 3"), sample["FiscalPeriod"])
    assert small.count() == 2 * 3 * 12


def test_generated_journals(sample):
    heads = generate.journal_headers_numbered(
        sample["BudgetHeader"].where("BudgetHeaderID = 1"), sample["FiscalPeriod"]).collect()
    assert {h.JournalNumber for h in heads} == {f"CONS-2024-{i}" for i in range(1, 6)}
    journal = sample["FiscalPeriod"].where("FiscalPeriodID <= 2").selectExpr("FiscalPeriodID AS JournalID")
    lines = generate.journal_lines_numbered(journal, sample["GLAccount"], sample["CostCenter"])
    assert lines.count() == 200
    assert lines.where("(DebitAmount > 0) = (CreditAmount > 0)").isEmpty()
    assert lines.where("GLAccountID = 20").isEmpty()  # not postable


def test_journals_share_no_ids(sample):
    ids, lines = [], []
    for run in (RUN, journals.Run(id="1" * 32, now=RUN.now)):
        for journal in (journals.cost_allocation_journal(sample["BudgetHeader"], run),
                        journals.consolidation_journal(sample["BudgetHeader"], run)):
            ids += [r.JournalID for r in journal.collect()]
            booked = journals.cost_allocation_lines(sample["BudgetLineItem"], journal, run)
            lines += [r.JournalLineID for r in booked.select("JournalLineID").collect()]
    assert len(set(ids)) == len(ids) == 12 and len(set(lines)) == len(lines) == 1000


def test_draws_reach_the_upper_half_of_wide_strata(spark):
    owners = spark.range(40).selectExpr("id AS owner", "CAST(86000000000000 AS DECIMAL(38,0)) AS size")
    cells = generate._drawn_cells(owners, "owner", 250, None, salt=11)
    inside = cells.selectExpr("CAST(cell % 344000000000 AS DOUBLE) / 344000000000 AS at")
    low, high = inside.selectExpr("min(at)", "max(at)").first()
    assert cells.distinct().count() == 40 * 250 and low < 0.01 and high > 0.99
    half = generate._drawn_cells(owners.selectExpr("owner", "CAST(9001 AS DECIMAL(38,0)) AS size"), "owner", None, 0.5, 3)
    assert half.distinct().count() == 40 * 4501


def test_repeated_centers_count_a_line_once(sample):
    centers = sample["CostCenter"].unionAll(sample["CostCenter"])
    once = {r.CostCenterCode: r for r in reports.cost_center_summary(sample["CostCenter"], sample["BudgetLineItem"]).collect()}
    for r in reports.cost_center_summary(centers, sample["BudgetLineItem"]).collect():
        assert r.BudgetLineCount == once[r.CostCenterCode].BudgetLineCount


def test_line_sample_passes_over_lines_without_an_account(sample):
    ledger = sample["BudgetLineItem"]
    cut = ledger.orderBy("BudgetLineItemID").limit(200).selectExpr(
        *["-1L AS GLAccountID" if c == "GLAccountID" else c for c in ledger.columns])
    rest = ledger.join(cut.select("BudgetLineItemID"), "BudgetLineItemID", "left_anti").select(*ledger.columns)
    found = reports.budget_line_sample(
        cut.unionByName(rest), sample["BudgetHeader"], sample["GLAccount"], sample["CostCenter"])
    want = rest.orderBy("BudgetLineItemID").limit(10).select("FinalAmount").collect()
    assert [r.FinalAmount for r in found.collect()] == [r.FinalAmount for r in want]


def test_a_run_folder_goes_with_its_block(spark):
    import os

    from ledgerwright.functions import stored

    with stored.run(spark) as folder:
        assert stored.materialize(spark.range(3), "x").count() == 3 and os.listdir(folder)
    assert not os.path.exists(folder)
