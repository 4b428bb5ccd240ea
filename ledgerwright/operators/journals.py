"""Cost-allocation and consolidation journals, one per budget.

A run is identified by ``Run``: its id and its clock are fixed before anything is
computed, and ids follow from them: a journal's from its kind, run and budget, a
line's from its journal and number. A retried task writes the same numbers, two
runs or two kinds share none, and nothing is read back.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import ZERO, quoted, rows, stamp, total
from ledgerwright.functions.numbering import number_rows
from ledgerwright.schemas import CONSOLIDATION_JOURNAL, TOTAL, complete

#: Room for the line numbers of a journal in its lines' ids.
LINES = 1_000_000_000_000


@dataclass(frozen=True)
class Run:
    """``id`` is 32 hex digits."""

    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    now: str = field(default_factory=lambda: datetime.now().strftime("%Y-%m-%d %H:%M:%S"))


def requested_headers(headers: DataFrame, ids: DataFrame) -> DataFrame:
    """The headers of the requested budget ids; an unknown or missing id is an error."""
    found = ids.select("BudgetHeaderID").distinct().join(
        headers.withColumn("_found", F.lit(True)), "BudgetHeaderID", "left"
    )
    checked = """CASE WHEN BudgetHeaderID IS NULL THEN CAST(raise_error('Budget header ID is required') AS BIGINT)
        WHEN _found IS NULL THEN CAST(raise_error('Budget header not found') AS BIGINT)
        ELSE BudgetHeaderID END AS BudgetHeaderID"""
    return found.selectExpr(*[checked if c == "BudgetHeaderID" else c for c in headers.columns])


def _suffix(run: Run) -> str:
    """Eight hex digits, random per run and different for every budget of a run."""
    return f"lpad(lower(hex((BudgetHeaderID + {int(run.id[:8], 16)}) % 4294967296)), 8, '0')"


def _journal(headers: DataFrame, run: Run, prefix: str, kind: str, about: str) -> DataFrame:
    number = f"concat('{prefix}', date_format({stamp(run.now)}, 'yyyyMMddHHmmss'), '-', {_suffix(run)})"
    journal = headers.selectExpr(
        f"CAST(conv(substr(md5(CAST(concat('{kind}/{run.id}/', BudgetHeaderID) AS BINARY)), 1, 15), 16, 10) AS BIGINT)"
        " AS JournalID",
        f"{number} AS JournalNumber",
        f"'{kind}' AS JournalType",
        "BudgetHeaderID",
        "StartPeriodID AS FiscalPeriodID",
        f"CAST({stamp(run.now)} AS DATE) AS PostingDate",
        f"concat({quoted(about)}, BudgetCode) AS Description",
        "'DRAFT' AS StatusCode",
        f"md5(CAST(concat('{run.id}', {number}) AS BINARY)) AS AttachmentRowGuid",
    )
    return complete(journal, CONSOLIDATION_JOURNAL, run.now)


def _lines(ledger: DataFrame, journal: DataFrame, run: Run) -> DataFrame:
    """Every ledger line of a journal's budget as a debit, numbered by line id."""
    entries = ledger.select(
        "BudgetHeaderID", "BudgetLineItemID", "GLAccountID", "CostCenterID", "FinalAmount"
    ).join(journal.select("BudgetHeaderID", "JournalID"), "BudgetHeaderID")
    return number_rows(entries, ["JournalID"], ["BudgetLineItemID"], "LineNumber").selectExpr(
        f"CAST(CAST(JournalID AS DECIMAL(19,0)) * {LINES}BD + LineNumber AS DECIMAL(38,0)) AS JournalLineID",
        "JournalID",
        "CAST(LineNumber AS INT) AS LineNumber",
        "GLAccountID",
        "CostCenterID",
        "FinalAmount AS DebitAmount",
        f"{ZERO} AS CreditAmount",
        "FinalAmount AS NetAmount",
        f"{stamp(run.now)} AS CreatedDateTime",
    )


def cost_allocation_journal(headers: DataFrame, run: Run) -> DataFrame:
    return _journal(headers, run, "ALLOC-", "ALLOCATION", "Cost allocation for budget ")


def cost_allocation_lines(ledger: DataFrame, journal: DataFrame, run: Run) -> DataFrame:
    return _lines(ledger, journal, run)


def cost_allocation_result(
    headers: DataFrame,
    ledger: DataFrame,
    rules: DataFrame,
    run: Run,
    basis_override: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """One result per budget. Active rules are counted, not applied; a dry run
    writes no journal and allocates nothing."""
    active = rules.where("IsActive").agg(rows().alias("n")).scalar()
    wide = TOTAL.simpleString()
    if dry_run:
        journal = headers.selectExpr(
            "BudgetHeaderID", f"CAST(0 AS {wide}) AS total", "CAST(NULL AS BIGINT) AS JournalID",
            "CAST(NULL AS STRING) AS JournalNumber",
        )
    else:
        sums = ledger.groupBy("BudgetHeaderID").agg(total("FinalAmount").alias("total"))
        journal = cost_allocation_journal(headers, run).join(sums, "BudgetHeaderID", "left")
    override = "CAST(NULL AS STRING)" if basis_override is None else quoted(basis_override)
    return journal.withColumn("rules_processed", active).selectExpr(
        "BudgetHeaderID",
        f"{stamp(run.now)} AS allocation_start",
        f"{stamp(run.now)} AS allocation_end",
        "rules_processed",
        f"CAST(coalesce(total, 0) AS {wide}) AS total_allocated",
        "0 AS error_count",
        f"{dry_run} AS dry_run",
        "JournalID AS journal_id",
        "JournalNumber AS journal_number",
        f"{override} AS allocation_basis_override",
        "'SUCCESS' AS status",
    )


def consolidation_journal(headers: DataFrame, run: Run, kind: str = "FULL") -> DataFrame:
    return _journal(headers, run, "CONSOL-", "CONSOLIDATION", f"Budget consolidation ({kind}) for budget ")


def _on_active_centers(ledger: DataFrame, centers: DataFrame) -> DataFrame:
    return ledger.join(centers.where("IsActive").select("CostCenterID"), "CostCenterID")


def consolidation_lines(ledger: DataFrame, centers: DataFrame, journal: DataFrame, run: Run) -> DataFrame:
    return _lines(_on_active_centers(ledger, centers), journal, run)


def consolidation_result(
    headers: DataFrame,
    ledger: DataFrame,
    centers: DataFrame,
    run: Run,
    kind: str = "FULL",
    eliminate_intercompany: bool = True,
) -> DataFrame:
    """One result per budget; nothing is eliminated.

    Lines are counted per budget and cost center before the join.
    """
    per_center = ledger.groupBy("BudgetHeaderID", "CostCenterID").agg(rows().alias("lines"))
    counts = _on_active_centers(per_center, centers).groupBy("BudgetHeaderID").agg(F.sum("lines").alias("lines"))
    journal = consolidation_journal(headers, run, kind)
    return journal.join(counts, "BudgetHeaderID", "left").selectExpr(
        f"{stamp(run.now)} AS consolidation_start",
        f"{stamp(run.now)} AS consolidation_end",
        "BudgetHeaderID AS budget_header_id",
        f"{quoted(kind)} AS consolidation_type",
        f"{eliminate_intercompany} AS eliminate_intercompany",
        "coalesce(lines, 0L) AS consolidated_lines",
        "JournalID AS journal_id",
        "JournalNumber AS journal_number",
        f"CAST(0 AS {TOTAL.simpleString()}) AS eliminated_amount",
        "'SUCCESS' AS status",
    )
