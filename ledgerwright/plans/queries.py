"""Every operator as a named query over the retail test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import money
from ledgerwright.operators import (
    allocation,
    audit,
    corpus,
    cycles,
    generate,
    hierarchy,
    importer,
    journals,
    parity,
    payload_chunks,
    period,
    reports,
    row_parity,
    stored_ledger,
    subtrees,
)
from ledgerwright.functions.stored import materialize, shared_folder, sized, slices
from ledgerwright.sources import files, retail, versions

Query = Callable[[SparkSession, str], DataFrame]

NOW = "2024-01-16 00:00:00"
BATCH = "import-0001"
RUN = journals.Run(id="0f1e2d3c4b5a69788796a5b4c3d2e1f0", now=NOW)
FORECAST_MONTHS = 18
CLOSE_BEFORE = "1998-07-01"

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def budget_consolidation_summary(spark, d):
    return reports.budget_consolidation_summary(
        retail.budget_lines(spark, d),
        retail.budget_headers(spark, d),
        retail.gl_accounts(spark, d),
        retail.cost_centers(spark, d),
        retail.fiscal_periods(spark, d),
    )


@query
def allocation_rule_targets(spark, d):
    return allocation.allocation_rule_targets(retail.allocation_rules(spark, d), retail.cost_centers(spark, d), NOW)


@query
def allocation_factor(spark, d):
    return allocation.allocation_factor(
        retail.factor_requests(spark, d), retail.budget_lines(spark, d), retail.cost_centers(spark, d)
    )


@query
def cost_center_path(spark, d):
    return hierarchy.cost_center_path(retail.cost_centers(spark, d))


@query
def cost_center_explode(spark, d):
    return hierarchy.cost_center_explode(retail.cost_centers(spark, d))


@query
def cost_center_labels(spark, d):
    return subtrees.center_labels(retail.cost_centers(spark, d))


@query
def budget_variance(spark, d):
    return reports.budget_variance(retail.budget_lines(spark, d))


@query
def import_payload_rows(spark, d):
    return importer.import_payload_rows(retail.import_payloads(spark, d))


@query
def import_chunk_rows(spark, d):
    return payload_chunks.import_chunk_rows(retail.import_chunks(spark, d))


@query
def import_resolve_keys(spark, d):
    return importer.import_resolve_keys(
        import_payload_rows(spark, d),
        retail.gl_accounts(spark, d, dirty=True),
        retail.cost_centers(spark, d),
        retail.fiscal_periods(spark, d),
    )


def _booked(spark, d):
    """The budget as it stands before the import: lines with status F."""
    return retail.budget_lines(spark, d, status="F")


@query
def import_validate(spark, d):
    rows = retail.order_lines(spark, d)
    with sized(spark, rows):
        return importer.import_validate(import_resolve_keys(spark, d), _booked(spark, d), "REJECT", slices=slices(rows))


def _imported(spark, d, duplicate_handling):
    rows = retail.order_lines(spark, d)
    with sized(spark, rows):
        return importer.run_import(
            retail.import_payloads(spark, d),
            _booked(spark, d),
            retail.gl_accounts(spark, d, dirty=True),
            retail.cost_centers(spark, d),
            retail.fiscal_periods(spark, d),
            BATCH,
            NOW,
            duplicate_handling,
            slices=slices(rows),
        )


@query
def import_apply(spark, d):
    ledger, _ = _imported(spark, d, "UPDATE")
    return ledger.select(
        "BudgetLineItemID", "BudgetHeaderID", "GLAccountID", "CostCenterID", "FiscalPeriodID", "OriginalAmount",
        "AdjustedAmount", "FinalAmount", "SpreadMethodCode", "ImportBatchID", "LastModifiedDateTime",
    )


@query
def import_result(spark, d):
    _, result = _imported(spark, d, "REJECT")
    return result


def _headers(spark, d):
    headers = retail.budget_headers(spark, d)
    return journals.requested_headers(headers, headers.select("BudgetHeaderID"))


@query
def cost_allocation_journal(spark, d):
    return journals.cost_allocation_journal(_headers(spark, d), RUN)


@query
def cost_allocation_lines(spark, d):
    journal = journals.cost_allocation_journal(_headers(spark, d), RUN)
    return journals.cost_allocation_lines(retail.budget_lines(spark, d), journal, RUN)


@query
def cost_allocation_result(spark, d):
    return journals.cost_allocation_result(
        _headers(spark, d), retail.budget_lines(spark, d), retail.allocation_rules(spark, d), RUN
    )


@query
def consolidation_journal(spark, d):
    return journals.consolidation_journal(_headers(spark, d), RUN)


@query
def consolidation_lines(spark, d):
    journal = journals.consolidation_journal(_headers(spark, d), RUN)
    return journals.consolidation_lines(retail.budget_lines(spark, d), retail.cost_centers(spark, d), journal, RUN)


@query
def consolidation_result(spark, d):
    return journals.consolidation_result(
        _headers(spark, d), retail.budget_lines(spark, d), retail.cost_centers(spark, d), RUN
    )


@query
def rolling_forecast(spark, d):
    return period.rolling_forecast(retail.budget_headers(spark, d), FORECAST_MONTHS)


@query
def rolling_forecast_result(spark, d):
    return period.rolling_forecast_result(rolling_forecast(spark, d))


def _closing(spark, d):
    """Periods that ended before the closing date."""
    return retail.fiscal_periods(spark, d).where(F.col("PeriodEndDate") < F.lit(CLOSE_BEFORE).cast("date"))


@query
def close_period(spark, d):
    return period.close_period(retail.fiscal_periods(spark, d), _closing(spark, d), NOW).select(
        "FiscalPeriodID", "FiscalYear", "FiscalMonth", "PeriodName", "IsClosed", "ClosedDateTime"
    )


@query
def close_lines(spark, d):
    return period.close_lines(retail.budget_lines(spark, d), _closing(spark, d)).select(
        "BudgetLineItemID", "BudgetHeaderID", "FiscalPeriodID", "FinalAmount", "IsAllocated"
    )


def _stored(spark, ledger: DataFrame) -> str:
    """The ledger as a stored table in a folder of its own."""
    root = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    files.write_table(ledger, root, stored_ledger.LEDGER, NOW)
    return root


@query
def close_lines_stored(spark, d):
    with sized(spark, retail.order_lines(spark, d)):
        root = _stored(spark, retail.budget_lines(spark, d))
        stored_ledger.close_published(spark, root, _closing(spark, d), BATCH, NOW)
    return versions.read_version(spark, root, stored_ledger.LEDGER).rows.select(*close_lines(spark, d).columns)


@query
def import_apply_stored(spark, d):
    with sized(spark, retail.order_lines(spark, d)):
        root = _stored(spark, _booked(spark, d))
        stored_ledger.import_published(
            spark,
            root,
            retail.import_payloads(spark, d),
            retail.gl_accounts(spark, d, dirty=True),
            retail.cost_centers(spark, d),
            retail.fiscal_periods(spark, d),
            BATCH,
            NOW,
            "UPDATE",
        )
    return versions.read_version(spark, root, stored_ledger.LEDGER).rows.select(
        "BudgetLineItemID", "BudgetHeaderID", "GLAccountID", "CostCenterID", "FiscalPeriodID", "OriginalAmount",
        "AdjustedAmount", "FinalAmount", "SpreadMethodCode", "ImportBatchID", "LastModifiedDateTime",
    )


@query
def intercompany_items(spark, d):
    return period.intercompany_items(
        retail.budget_lines(spark, d), retail.gl_accounts(spark, d), retail.cost_centers(spark, d)
    )


@query
def intercompany_result(spark, d):
    return period.intercompany_result(intercompany_items(spark, d), retail.fiscal_periods(spark, d))


@query
def hierarchy_nodes(spark, d):
    return hierarchy.hierarchy_nodes(retail.hierarchy_payloads(spark, d))


@query
def cleanup_allocation_results(spark, d):
    return period.cleanup_allocation_results(retail.allocation_results(spark, d), NOW)


@query
def kept_allocation_results(spark, d):
    return period.kept_allocation_results(retail.allocation_results(spark, d), NOW).select(
        "AllocationSessionID", "SourceBudgetLineItemID", "AllocatedAmount", "CreatedDateTime"
    )


@query
def table_counts(spark, d):
    return reports.table_counts(retail.core_tables(spark, d, numbered=False))


@query
def budget_line_sample(spark, d):
    return reports.budget_line_sample(
        retail.budget_lines(spark, d),
        retail.budget_headers(spark, d),
        retail.gl_accounts(spark, d),
        retail.cost_centers(spark, d),
    )


@query
def budget_analysis(spark, d):
    return reports.budget_analysis(retail.budget_lines(spark, d), retail.budget_headers(spark, d))


@query
def cost_center_summary(spark, d):
    return reports.cost_center_summary(retail.cost_centers(spark, d), retail.budget_lines(spark, d))


@query
def gl_account_distribution(spark, d):
    return reports.gl_account_distribution(
        retail.gl_accounts(spark, d), retail.budget_headers(spark, d), retail.budget_lines(spark, d)
    )


@query
def budget_header_bounds(spark, d):
    return period.budget_header_bounds(retail.fiscal_periods(spark, d))


@query
def budget_grid(spark, d):
    return generate.budget_grid(
        retail.budget_headers(spark, d),
        retail.gl_accounts(spark, d),
        retail.cost_centers(spark, d),
        retail.fiscal_periods(spark, d),
    )


@query
def journal_headers_numbered(spark, d):
    return generate.journal_headers_numbered(retail.budget_headers(spark, d), retail.fiscal_periods(spark, d))


@query
def journal_lines_numbered(spark, d):
    return generate.journal_lines_numbered(
        retail.journals(spark, d), retail.gl_accounts(spark, d), retail.cost_centers(spark, d)
    )


def _drifted(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A copy with a lost period, rounded amounts, padded, cut and changed text."""
    copy = dict(tables)
    copy["FiscalPeriod"] = copy["FiscalPeriod"].where(F.col("FiscalPeriodID") != 199606)
    copy["GLAccount"] = copy["GLAccount"].withColumn("AccountName", F.expr("concat(AccountName, '   ')"))
    copy["CostCenter"] = copy["CostCenter"].withColumn("CostCenterName", F.left("CostCenterName", F.lit(8)))
    copy["BudgetHeader"] = copy["BudgetHeader"].withColumn(
        "StatusCode", F.when(F.col("FiscalYear") == 1996, "APPROVED").otherwise(F.col("StatusCode"))
    )
    rounded = F.when(F.col("GLAccountID") == 7, money(F.round("OriginalAmount", 0)))
    copy["BudgetLineItem"] = copy["BudgetLineItem"].withColumn(
        "OriginalAmount", F.coalesce(rounded, "OriginalAmount")
    )
    return copy


def _parity(spark, d):
    tables = retail.core_tables(spark, d, numbered=False)
    return parity.run_parity(spark, parity.read_spec(parity.PLANNING_SPEC), tables, _drifted(tables))


@query
def parity_metrics(spark, d):
    tables = retail.core_tables(spark, d, numbered=False)
    spec = parity.read_spec(parity.PLANNING_SPEC)
    return reduce(DataFrame.unionByName, [parity.parity_metrics(t, m, tables[t]) for t, m in spec.items()])


@query
def parity_diff(spark, d):
    return parity.parity_diff(_parity(spark, d))


@query
def parity_report(spark, d):
    return parity.parity_report(_parity(spark, d))


@query
def parity_rows(spark, d):
    with sized(spark, 2 * retail.order_lines(spark, d)):
        return materialize(_parity_rows(spark, d), "differences")


def _parity_rows(spark, d):
    # Both tables of ledger lines are read for their key ranges, their leaves and their differences, on both sides.
    ledger = materialize(retail.budget_lines(spark, d), "ledger")
    tables = retail.core_tables(spark, d, numbered=False, ledger=ledger)
    copy = _drifted(tables)
    # Neighbouring accounts swap their numbers, and their lines' amounts change places: no aggregate shows it.
    swapped = "GLAccountID + CASE GLAccountID % 50 WHEN 10 THEN 1 WHEN 11 THEN -1 ELSE 0 END"
    copy["GLAccount"] = copy["GLAccount"].withColumn("AccountNumber", F.expr(f"CAST({swapped} AS STRING)"))
    copy["ConsolidationJournalLine"] = copy["ConsolidationJournalLine"].withColumn(
        "NetAmount", F.expr("CASE WHEN CostCenterID % 2 = 0 AND NetAmount > 50000 THEN -NetAmount ELSE NetAmount END")
    )
    return row_parity.parity_rows(spark, row_parity.read_row_spec(parity.PLANNING_SPEC), tables, copy)


@query
def sql_corpus_findings(spark, d):
    return corpus.sql_corpus_findings(retail.sql_corpus(spark, d), "info")


@query
def sql_corpus_tally(spark, d):
    return corpus.sql_corpus_tally(corpus.sql_corpus_findings(retail.sql_corpus(spark, d), "info"))


@query
def sql_script_findings(spark, d):
    return corpus.sql_chunk_findings(retail.sql_scripts(spark, d), "info")


def _audited(spark, d, numbered=False):
    """Core tables and a staging table, with ambiguous account numbers."""
    tables = retail.core_tables(spark, d, numbered)
    tables["GLAccount"] = retail.gl_accounts(spark, d, dirty=True)
    tables["AllocationResultStaging"] = retail.allocation_results(spark, d)
    return tables


@query
def audit_unique(spark, d):
    # Every ledger line has two keys, and so has every journal line.
    with sized(spark, 4 * retail.order_lines(spark, d)):
        return materialize(audit.audit_unique(_audited(spark, d, numbered=True)), "repeated")


@query
def audit_foreign_keys(spark, d):
    tables = _audited(spark, d)
    # cost centers that closed leave their ledger lines behind
    tables["CostCenter"] = tables["CostCenter"].where("IsActive")
    return audit.audit_foreign_keys(tables)


@query
def audit_checks(spark, d):
    tables = _audited(spark, d)
    # the net amount on the debit side: negative wherever the line is a credit
    tables["ConsolidationJournalLine"] = tables["ConsolidationJournalLine"].withColumn("DebitAmount", F.col("NetAmount"))
    return audit.audit_checks(tables)


@query
def audit_not_null(spark, d):
    tables = _audited(spark, d)
    tables["BudgetLineItem"] = tables["BudgetLineItem"].withColumn(
        "FinalAmount", F.when(F.col("LocalCurrencyAmount").isNull(), F.col("FinalAmount"))
    )
    return audit.audit_not_null(tables)


@query
def audit_invariants(spark, d):
    ledger = retail.budget_lines(spark, d)
    changed = ledger.withColumn("FinalAmount", money(F.round("FinalAmount", 1)))
    return audit.audit_invariants(
        changed,
        retail.journals(spark, d),
        retail.journal_lines(spark, d, numbered=False),
        retail.budget_headers(spark, d),
    )


#: Parents that turn some hierarchies into rings: accounts in chains of 200 of which the first 120 close, and cost
#: centers of three with a fourth beside them.
RINGS = {
    "GLAccount": ("ParentAccountID", "GLAccountID + CASE WHEN GLAccountID % 200 = 1 THEN 119 ELSE -1 END"),
    "CostCenter": (
        "ParentCostCenterID",
        """CASE WHEN CostCenterID < 1000 THEN ParentCostCenterID WHEN CostCenterID % 10 IN (1, 2, 4) THEN CostCenterID + 1
        WHEN CostCenterID % 10 IN (3, 5) THEN CostCenterID - 2 ELSE ParentCostCenterID END""",
    ),
    "BudgetHeader": ("BaseBudgetHeaderID", "BudgetHeaderID - 1"),
}


@query
def audit_cycles(spark, d):
    tables = retail.core_tables(spark, d, numbered=False)
    for name, (column, parent) in RINGS.items():
        tables[name] = tables[name].withColumn(column, F.expr(f"CAST({parent} AS BIGINT)"))
    return cycles.audit_cycles(tables)
