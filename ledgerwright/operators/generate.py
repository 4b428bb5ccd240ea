"""Generated sample ledgers and journals.

The grid of budgets, accounts, cost centers and periods is never enumerated:
cells are drawn by number and decoded with equi joins, so the work follows the
number of lines asked for. Draws are repeatable arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import ZERO, rows, scramble, scramble_wide
from ledgerwright.functions.numbering import number_rows
from ledgerwright.schemas import NATURAL_KEY

#: Amount range by account type (others last), the largest
#: adjustment, journal line amounts, months that get a journal, lines drawn.
AMOUNT_RANGES = {"R": (100000, 600000), "X": (10000, 60000)}
OTHER_RANGE = (0, 100000)
JOURNAL_RANGE = (1000, 11000)
JOURNAL_MONTHS = (1, 3, 6, 9, 12)
LEDGER_LINES = 250
JOURNAL_LINES = 100

_WIDE = "DECIMAL(38,0)"
#: Draws that one row unfolds to at a time.
_BLOCK = 4096


def uniform(low: int, high: int, draw: str) -> str:
    """An amount in whole cents between ``low`` and ``high``, both included."""
    return f"CAST(CAST({draw} % {(high - low) * 100 + 1} + {low * 100} AS DECIMAL(17,0)) * 0.01BD AS DECIMAL(19,2))"


def _indexed(df: DataFrame, key: str, index: str) -> DataFrame:
    """Adds a dense index from 0 in key order."""
    return number_rows(df, [], [key], "_n").selectExpr(*df.columns, f"_n - 1 AS {index}")


def _counted(df: DataFrame) -> Column:
    return df.agg(rows().alias("n")).scalar()


def _quotient(value: str, by: str) -> str:
    return f"CAST(({value} - {value} % {by}) / {by} AS {_WIDE})"


def _drawn_cells(owners: DataFrame, owner: str, lines: int | None, rate: float | None, salt: int) -> DataFrame:
    """Different cell numbers below ``size`` for each owner: a share ``rate`` of them, ``lines`` at most.

    The cells are cut into as many equal strata as lines and one cell is drawn
    from each; a grid with fewer cells gives every cell once. Draws reach any cell
    of strata of up to 2**62 cells.
    """
    wanted = "size" if rate is None else f"CAST(ceil(CAST(size AS DOUBLE) * {rate}) AS {_WIDE})"
    if lines is not None:
        wanted = f"least({wanted}, CAST({lines} AS {_WIDE}))"
    return (
        owners.selectExpr("*", f"least(size, {wanted}) AS wanted")
        .where("wanted > 0")
        .selectExpr("*", f"explode(sequence(0L, CAST((wanted - 1) / {_BLOCK} AS BIGINT))) AS _block")
        .selectExpr(
            "*", f"explode(sequence(_block * {_BLOCK}, least(_block * {_BLOCK} + {_BLOCK - 1}, CAST(wanted AS BIGINT) - 1))) AS draw"
        )
        .selectExpr("*", f"CAST(draw * size AS {_WIDE}) AS _from", f"CAST((draw + 1) * size AS {_WIDE}) AS _to")
        .selectExpr("*", f"{_quotient('_from', 'wanted')} AS _low", f"{_quotient('_to', 'wanted')} AS _high")
        .selectExpr(
            *owners.columns,
            f"CAST(_low + {scramble_wide(owner, 'draw', salt=salt)} % CAST(_high - _low AS {_WIDE}) AS {_WIDE}) AS cell",
        )
    )


def _decoded(cells: DataFrame, sizes: dict[str, str]) -> DataFrame:
    """Splits ``cell`` into one index per dimension, the first varying fastest."""
    for index, size in sizes.items():
        wide = f"CAST({size} AS {_WIDE})"
        cells = cells.selectExpr(
            *[c for c in cells.columns if c != "cell"],
            f"CAST(cell % {wide} AS BIGINT) AS {index}",
            f"{_quotient('cell', wide)} AS cell",
        )
    return cells.drop("cell")


def _base_amount() -> str:
    draw = scramble(*NATURAL_KEY, salt=1)
    ranges = " ".join(f"WHEN '{kind}' THEN {uniform(*limits, draw)}" for kind, limits in AMOUNT_RANGES.items())
    return f"CASE AccountType {ranges} ELSE {uniform(*OTHER_RANGE, draw)} END"


def _up_to_a_tenth(salt: int) -> str:
    """The base amount times a draw from 0 to 0.1, in cents."""
    share = f"CAST({scramble(*NATURAL_KEY, salt=salt)} % 10001 AS DECIMAL(5,0)) * 0.00001BD"
    return f"CAST(round(base * {share}, 2) AS DECIMAL(19,2))"


def budget_grid(
    headers: DataFrame,
    accounts: DataFrame,
    centers: DataFrame,
    periods: DataFrame,
    lines: int | None = LEDGER_LINES,
    rate: float | None = None,
) -> DataFrame:
    """Sample ledger lines: per budget, distinct cells of budgetable account,
    active cost center and period of its year, a share ``rate`` of all and at
    most ``lines`` unless that is None.

    The adjusted amount and the adjustment inside the final amount are two
    separate draws.
    """
    accounts, centers = accounts.where("IsBudgetable"), centers.where("IsActive")
    usable = _indexed(accounts.select("GLAccountID", "AccountType"), "GLAccountID", "a")
    active = _indexed(centers.select("CostCenterID"), "CostCenterID", "c")
    year = Window.partitionBy("FiscalYear").orderBy("FiscalMonth", "FiscalPeriodID")
    months = periods.select(
        "FiscalYear", "FiscalPeriodID", (F.row_number().over(year) - 1).cast("bigint").alias("p")
    )
    per_year = periods.groupBy("FiscalYear").agg(rows().alias("periods"))
    n_accounts, n_centers = _counted(accounts), _counted(centers)
    owners = (
        headers.select("BudgetHeaderID", "FiscalYear")
        .join(per_year, "FiscalYear")
        .withColumn("accounts", n_accounts)
        .withColumn("centers", n_centers)
        .selectExpr(
            "*",
            f"CAST(CAST(accounts AS {_WIDE}) * CAST(centers AS {_WIDE}) * CAST(periods AS {_WIDE}) AS {_WIDE}) AS size",
        )
    )
    cells = _decoded(
        _drawn_cells(owners, "BudgetHeaderID", lines, rate, salt=11), {"a": "accounts", "c": "centers", "p": "periods"}
    )
    return (
        cells.join(usable, "a")
        .join(active, "c")
        .join(months, ["FiscalYear", "p"])
        .selectExpr(*NATURAL_KEY, f"{_base_amount()} AS base")
        .selectExpr(
            *NATURAL_KEY,
            "CAST(base AS DECIMAL(19,4)) AS OriginalAmount",
            f"CAST({_up_to_a_tenth(2)} AS DECIMAL(19,4)) AS AdjustedAmount",
            f"CAST(base + {_up_to_a_tenth(3)} AS DECIMAL(19,4)) AS FinalAmount",
            "'EVEN' AS SpreadMethodCode",
            "false AS IsAllocated",
        )
    )


def journal_headers_numbered(headers: DataFrame, periods: DataFrame) -> DataFrame:
    """A journal per budget for the closing months of its year, numbered per year."""
    closing = periods.where(F.col("FiscalMonth").isin(*JOURNAL_MONTHS)).select(
        "FiscalYear", "FiscalPeriodID", "PeriodEndDate", "PeriodName"
    )
    planned = headers.select("BudgetHeaderID", "FiscalYear").join(closing, "FiscalYear")
    return number_rows(planned, ["FiscalYear"], ["BudgetHeaderID", "FiscalPeriodID"], "n").selectExpr(
        "concat('CONS-', FiscalYear, '-', n) AS JournalNumber",
        "'ELIMINATION' AS JournalType",
        "BudgetHeaderID",
        "FiscalPeriodID",
        "PeriodEndDate AS PostingDate",
        "concat('Consolidation adjustments for ', PeriodName) AS Description",
        "'DRAFT' AS StatusCode",
        "false AS IsBalanced",
    )


def journal_lines_numbered(
    journals: DataFrame,
    accounts: DataFrame,
    centers: DataFrame,
    lines: int | None = JOURNAL_LINES,
    rate: float | None = None,
) -> DataFrame:
    """Sample lines per journal, numbered by account and cost center.

    ``lines`` and ``rate`` are as in budget_grid; a journal's lines are numbered in one
    window. The three amounts are separate draws.
    """
    accounts, centers = accounts.where("IsPostable"), centers.where("IsActive")
    postable = _indexed(accounts.select("GLAccountID", "AccountName", "NormalBalance"), "GLAccountID", "a")
    active = _indexed(centers.select("CostCenterID", "CostCenterName"), "CostCenterID", "c")
    n_accounts, n_centers = _counted(accounts), _counted(centers)
    owners = (
        journals.select("JournalID")
        .withColumn("accounts", n_accounts)
        .withColumn("centers", n_centers)
        .selectExpr("*", f"CAST(CAST(accounts AS {_WIDE}) * CAST(centers AS {_WIDE}) AS {_WIDE}) AS size")
    )
    cells = _decoded(_drawn_cells(owners, "JournalID", lines, rate, salt=12), {"a": "accounts", "c": "centers"})

    def amount(salt: int) -> str:
        draw = scramble("JournalID", "GLAccountID", "CostCenterID", salt=salt)
        return f"CAST({uniform(*JOURNAL_RANGE, draw)} AS DECIMAL(19,4))"

    debit = "NormalBalance = 'D'"
    return (
        cells.join(postable, "a")
        .join(active, "c")
        .selectExpr(
            "JournalID",
            "row_number() OVER (PARTITION BY JournalID ORDER BY GLAccountID, CostCenterID) AS LineNumber",
            "GLAccountID",
            "CostCenterID",
            f"CASE WHEN {debit} THEN {amount(4)} ELSE {ZERO} END AS DebitAmount",
            f"CASE WHEN {debit} THEN {ZERO} ELSE {amount(5)} END AS CreditAmount",
            f"CAST(CASE WHEN {debit} THEN {amount(6)} ELSE -{amount(6)} END AS DECIMAL(19,4)) AS NetAmount",
            "concat('Consolidation: ', AccountName, ' - ', CostCenterName) AS Description",
        )
    )
