"""Bulk import of budget lines from JSON payloads.

Five steps, each a DataFrame: parse, resolve keys, validate, apply, report.
A payload row names its target budget, so one run imports into many budgets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import ZERO, key_id, quoted, rows, stamp
from ledgerwright.functions.stored import Pieces, in_slice, materialize
from ledgerwright.operators.hierarchy import elements, field
from ledgerwright.schemas import BUDGET_LINE_ITEM, LINE_ID, NATURAL_KEY, complete

#: How to treat lines that exist, modes that require an amount,
#: rejection reasons in the order they are given, rejections listed in a result.
DUPLICATE_HANDLING = ("REJECT", "UPDATE")
STRICT_MODES = ("STRICT", "LENIENT")
UNKNOWN_ACCOUNT = "Unknown or ambiguous account_number"
UNKNOWN_COST_CENTER = "Unknown or ambiguous cost_center_code"
NO_PERIOD = "No unique fiscal period for fiscal_year/fiscal_month"
MISSING_FIELDS = "Missing required fields"
DUPLICATE_KEY = "Duplicate key within the import payload"
LINE_EXISTS = "Line already exists in the target budget"
LISTED_REJECTIONS = 100

KEYS = list(NATURAL_KEY)


def import_payload_rows(payloads: DataFrame) -> DataFrame:
    """Typed rows of (payload_id, BudgetHeaderID, payload), numbered within a payload."""
    return typed_rows(elements(payloads, "payload").withColumn("row_id", F.col("pos") + 1))


def typed_rows(numbered: DataFrame) -> DataFrame:
    """The fields of payload elements (payload_id, BudgetHeaderID, row_id, value)."""
    return numbered.selectExpr(
        "payload_id",
        "BudgetHeaderID",
        "row_id",
        field("account_number", "string"),
        field("cost_center_code", "string"),
        field("fiscal_year", "int"),
        field("fiscal_month", "int"),
        field("original_amount", "decimal(19,4)"),
        field("adjusted_amount", "decimal(19,4)"),
        field("spread_method_code", "string"),
        field("notes", "string"),
    )


def _unique(dimension: DataFrame, keys: dict[str, str], id_: str) -> DataFrame:
    """Key -> id, for the keys that occur once."""
    return (
        dimension.selectExpr(*[f"{c} AS {k}" for k, c in keys.items()], id_)
        .groupBy(*keys)
        .agg(F.min(id_).alias(id_), rows().alias("_n"))
        .where("_n = 1")
        .drop("_n")
    )


def import_resolve_keys(staged: DataFrame, accounts: DataFrame, centers: DataFrame, periods: DataFrame) -> DataFrame:
    """Natural keys to ids. A key found twice stays unresolved."""
    by_number = _unique(accounts, {"account_number": "AccountNumber"}, "GLAccountID")
    by_code = _unique(centers, {"cost_center_code": "CostCenterCode"}, "CostCenterID")
    by_month = _unique(periods, {"fiscal_year": "FiscalYear", "fiscal_month": "FiscalMonth"}, "FiscalPeriodID")
    return (
        staged.join(by_number, "account_number", "left")
        .join(by_code, "cost_center_code", "left")
        .join(by_month, ["fiscal_year", "fiscal_month"], "left")
        .select(*staged.columns, "GLAccountID", "CostCenterID", "FiscalPeriodID")
    )


def _known_keys(resolved: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per key that needs attention: repeated in the import, or in the ledger.

    Both sides are counted in one aggregation, so a key that fills a third of
    the import is reduced on the map side and never becomes one window.
    """
    complete_key = " AND ".join(f"{k} IS NOT NULL" for k in KEYS)
    incoming = resolved.where(complete_key).selectExpr(*KEYS, "1 AS incoming", "0 AS booked")
    booked = ledger.selectExpr(*KEYS, "0 AS incoming", "1 AS booked")
    return (
        incoming.unionByName(booked)
        .groupBy(*KEYS)
        .agg(F.sum("incoming").alias("copies"), F.max("booked").alias("exists"))
        .where("copies > 1 OR (copies = 1 AND exists = 1)")
        .selectExpr(*KEYS, "copies > 1 AS _repeated", "exists = 1 AS _exists")
    )


def import_validate(
    resolved: DataFrame,
    ledger: DataFrame,
    duplicate_handling: str = "REJECT",
    validation_mode: str = "STRICT",
    stored: bool = False,
    slices: int = 1,
) -> DataFrame:
    """Adds ``is_valid``, ``validation_errors`` (the first reason) and ``line_exists``.

    A repeated key rejects all its rows, also where one of them is invalid for
    another reason. ``line_exists`` is only looked up for rows that pass so far.
    The resolved rows are stored first: they are read for their keys and again
    for the rows, and reading them costs less than parsing the payloads twice. Pass
    ``stored=True`` for rows that are.

    With several ``slices`` the rows are resolved and stored by slices of the payloads, then
    judged and stored by slices of the keys, and what was judged is removed: the disk holds
    the shuffles of one slice at a time. The result is stored.
    """
    if duplicate_handling not in DUPLICATE_HANDLING:
        raise ValueError("Duplicate handling must be REJECT or UPDATE")
    if stored or slices == 1:
        resolved = resolved if stored else materialize(resolved, "staged")
        return _validated(resolved, ledger, duplicate_handling, validation_mode)
    spark = resolved.sparkSession
    staged, booked, judged = Pieces(spark, "staged", KEYS, slices), Pieces(spark, "booked", KEYS, slices), Pieces(spark, "judged")
    for k in range(slices):
        staged.add(resolved.where(in_slice(["payload_id"], slices, k)))
    booked.add(ledger.select(*KEYS))
    for k in range(slices):
        judged.add(_validated(staged.rows(k), booked.rows(k), duplicate_handling, validation_mode))
        staged.drop(k)
    for done in (staged, booked):
        done.drop()
    return judged.rows()


def _validated(resolved: DataFrame, ledger: DataFrame, duplicate_handling: str, validation_mode: str) -> DataFrame:
    missing = "original_amount IS NULL" if validation_mode in STRICT_MODES else "false"
    reason = f"""CASE WHEN GLAccountID IS NULL THEN '{UNKNOWN_ACCOUNT}'
        WHEN CostCenterID IS NULL THEN '{UNKNOWN_COST_CENTER}'
        WHEN FiscalPeriodID IS NULL THEN '{NO_PERIOD}'
        WHEN {missing} THEN '{MISSING_FIELDS}'
        WHEN coalesce(_repeated, false) THEN '{DUPLICATE_KEY}' END AS _reason"""
    error = "_reason"
    if duplicate_handling == "REJECT":
        error = f"CASE WHEN line_exists THEN '{LINE_EXISTS}' ELSE _reason END"
    return (
        resolved.join(_known_keys(resolved, ledger), KEYS, "left")
        .selectExpr(*resolved.columns, "_exists", reason)
        .selectExpr(*resolved.columns, "_reason", "_reason IS NULL AND coalesce(_exists, false) AS line_exists")
        .selectExpr(*resolved.columns, f"{error} AS validation_errors", "line_exists")
        .selectExpr(*resolved.columns, "validation_errors IS NULL AS is_valid", "validation_errors", "line_exists")
    )


#: The amounts to write; a missing original is an error, as its column requires one.
_ORIGINAL = """coalesce(original_amount,
    CAST(raise_error('NULL original_amount in a required column') AS DECIMAL(19,4)))"""
_ADJUSTED = f"coalesce(adjusted_amount, {ZERO})"


def import_inserts(validated: DataFrame, batch_id: str, now: str, new_id: str | None = None) -> DataFrame:
    """New ledger lines. Ids are the SQL expression ``new_id``, or follow from batch, payload and row."""
    new_id = new_id or key_id(quoted(batch_id), "payload_id", "row_id")
    lines = validated.where("is_valid AND NOT line_exists").selectExpr(
        f"CAST({new_id} AS {LINE_ID.simpleString()}) AS BudgetLineItemID",
        *KEYS,
        f"{_ORIGINAL} AS OriginalAmount",
        f"{_ADJUSTED} AS AdjustedAmount",
        f"CAST({_ORIGINAL} + {_ADJUSTED} AS DECIMAL(19,4)) AS FinalAmount",
        "spread_method_code AS SpreadMethodCode",
        f"{quoted(batch_id)} AS ImportBatchID",
        f"{stamp(now)} AS LastModifiedDateTime",
    )
    return complete(lines, BUDGET_LINE_ITEM, now)


def import_updates(ledger: DataFrame, validated: DataFrame, batch_id: str, now: str) -> DataFrame:
    """The ledger with the amounts of imported lines overwritten.

    Valid keys occur once in the import, so no line is written twice.
    """
    changes = validated.where("is_valid AND line_exists").selectExpr(
        *KEYS,
        f"{_ORIGINAL} AS _original",
        f"{_ADJUSTED} AS _adjusted",
        "spread_method_code AS _spread",
        "true AS _changed",
    )
    new_values = {
        "OriginalAmount": "_original",
        "AdjustedAmount": "_adjusted",
        "FinalAmount": "CAST(_original + _adjusted AS DECIMAL(19,4))",
        "SpreadMethodCode": "coalesce(_spread, SpreadMethodCode)",
        "ImportBatchID": quoted(batch_id),
        "LastModifiedDateTime": stamp(now),
    }
    return ledger.join(changes, KEYS, "left").selectExpr(*[
        f"CASE WHEN _changed THEN {new_values[c]} ELSE {c} END AS {c}" if c in new_values else c
        for c in ledger.columns
    ])


def run_import(
    payloads: DataFrame,
    ledger: DataFrame,
    accounts: DataFrame,
    centers: DataFrame,
    periods: DataFrame,
    batch_id: str,
    now: str,
    duplicate_handling: str = "REJECT",
    validation_mode: str = "STRICT",
    new_id: str | None = None,
    slices: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """All steps: the ledger after the import, and the result per budget.

    The validated rows are stored once and read by both.
    """
    resolved = import_resolve_keys(import_payload_rows(payloads), accounts, centers, periods)
    validated = import_validate(resolved, ledger, duplicate_handling, validation_mode, slices=slices)
    validated = materialize(validated, "validated") if slices == 1 else validated
    return (
        import_apply(ledger, validated, batch_id, now, duplicate_handling, new_id),
        import_result(validated, batch_id, duplicate_handling),
    )


def import_apply(
    ledger: DataFrame,
    validated: DataFrame,
    batch_id: str,
    now: str,
    duplicate_handling: str = "REJECT",
    new_id: str | None = None,
) -> DataFrame:
    """The ledger after the import: lines updated (UPDATE only), new lines added."""
    if duplicate_handling not in DUPLICATE_HANDLING:
        raise ValueError("Duplicate handling must be REJECT or UPDATE")
    kept = import_updates(ledger, validated, batch_id, now) if duplicate_handling == "UPDATE" else ledger
    return kept.unionByName(import_inserts(validated, batch_id, now, new_id).select(*ledger.columns))


def import_result(
    validated: DataFrame, batch_id: str, duplicate_handling: str = "REJECT", source: str = "VARIANT"
) -> DataFrame:
    """One result per target budget, with its first rejections.

    The rank filter is applied before the shuffle as well, so no more than the
    listed rejections per budget and partition move.
    """
    counts = validated.groupBy("BudgetHeaderID").agg(
        rows().alias("total_rows_loaded"),
        F.expr("count_if(is_valid AND NOT line_exists)").alias("rows_inserted"),
        F.expr("count_if(is_valid AND line_exists)").alias("rows_updated"),
    )
    order = ["payload_id", "row_id", "account_number", "cost_center_code", "validation_errors"]
    first = Window.partitionBy("BudgetHeaderID").orderBy(*order)
    listed = (
        validated.where("NOT is_valid")
        .select("BudgetHeaderID", *order)
        .withColumn("_rank", F.row_number().over(first))
        .where(f"_rank <= {LISTED_REJECTIONS}")
        .groupBy("BudgetHeaderID")
        .agg(F.expr(f"array_sort(collect_list(struct(_rank, {', '.join(order)})))").alias("ranked"))
    )
    rejection = """named_struct('payload_id', r.payload_id, 'row', r.row_id, 'account_number', r.account_number,
        'cost_center_code', r.cost_center_code, 'error', r.validation_errors)"""
    return (
        counts.join(listed, "BudgetHeaderID", "left")
        .selectExpr("*", "rows_inserted + rows_updated AS rows_imported")
        .selectExpr("*", "total_rows_loaded - rows_imported AS rows_rejected")
        .selectExpr(
            f"{quoted(batch_id)} AS import_batch_id",
            f"{quoted(source)} AS import_source",
            f"{quoted(duplicate_handling)} AS duplicate_handling",
            "BudgetHeaderID",
            "total_rows_loaded",
            "rows_imported",
            "rows_inserted",
            "rows_updated",
            "rows_rejected",
            f"coalesce(to_json(transform(ranked, r -> {rejection})), '[]') AS rejections",
            """CASE WHEN rows_rejected = 0 THEN 'SUCCESS' WHEN rows_imported = 0 THEN 'FAILED'
                ELSE 'PARTIAL_SUCCESS' END AS status""",
        )
    )
