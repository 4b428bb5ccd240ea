import json
from decimal import Decimal

import pytest
from sample_ledger import NOW, value

from ledgerwright.operators import importer

# The three rows of the first payload, by (account, center): amounts.
PAYLOAD = [
    {"account_number": "4000", "cost_center_code": "OPS", "fiscal_year": 2024, "fiscal_month": 4,
     "original_amount": 175000.00, "adjusted_amount": 8500.00, "spread_method_code": "EVEN"},
    {"account_number": "5000", "cost_center_code": "SALES", "fiscal_year": 2024, "fiscal_month": 4,
     "original_amount": 85000.00, "adjusted_amount": -2500.00, "spread_method_code": "EVEN"},
    {"account_number": "5200", "cost_center_code": "HR", "fiscal_year": 2024, "fiscal_month": 4,
     "original_amount": 25000.00, "adjusted_amount": 0, "spread_method_code": "EVEN"},
]
BAD = [
    {**PAYLOAD[0], "account_number": "9999"},
    {**PAYLOAD[1], "fiscal_month": 5},
    {**PAYLOAD[1], "fiscal_month": 5},
]


def payloads(spark, *documents):
    rows = [(f"p{i}", 1, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "payload_id string, BudgetHeaderID bigint, payload string")


def imported(spark, sample, ledger, handling, *documents, **options):
    ledger, result = importer.run_import(
        payloads(spark, *documents), ledger, sample["GLAccount"], sample["CostCenter"], sample["FiscalPeriod"],
        "batch", NOW, handling, **options,
    )
    return ledger.cache(), result.first()


def reasons(spark, sample, *documents, ledger=None, mode="STRICT", handling="REJECT"):
    rows = importer.import_resolve_keys(
        importer.import_payload_rows(payloads(spark, *documents)),
        sample["GLAccount"], sample["CostCenter"], sample["FiscalPeriod"],
    )
    checked = importer.import_validate(rows, ledger or sample["BudgetLineItem"].limit(0), handling, mode)
    return [r["validation_errors"] for r in checked.orderBy("payload_id", "row_id").collect()]


def test_update_then_reject(spark, sample):
    before = sample["BudgetLineItem"]
    after, result = imported(spark, sample, before, "UPDATE", PAYLOAD)
    assert (result.rows_imported, result.rows_rejected, result.status) == (3, 0, "SUCCESS")
    assert after.count() == before.count() + result.rows_inserted
    keyed = after.where("ImportBatchID = 'batch'")
    assert keyed.count() == 3 and after.select("BudgetLineItemID").distinct().count() == after.count()
    ops = keyed.where("GLAccountID = 1 AND CostCenterID = 2 AND FiscalPeriodID = 4")
    assert value(ops.select("FinalAmount")) == Decimal("183500")

    again, result = imported(spark, sample, after, "REJECT", PAYLOAD)
    assert (result.rows_imported, result.rows_rejected, result.status) == (0, 3, "FAILED")
    assert again.count() == after.count()
    assert {r["error"] for r in json.loads(result.rejections)} == {importer.LINE_EXISTS}

    same, result = imported(spark, sample, after, "UPDATE", PAYLOAD)
    assert (result.rows_updated, result.rows_inserted) == (3, 0)
    assert same.drop("LastModifiedDateTime").exceptAll(after.drop("LastModifiedDateTime")).isEmpty()


def test_bad_rows_are_all_rejected(spark, sample):
    _, result = imported(spark, sample, sample["BudgetLineItem"], "UPDATE", BAD)
    assert (result.rows_imported, result.rows_rejected) == (0, 3)
    assert [r["error"] for r in json.loads(result.rejections)] == [
        importer.UNKNOWN_ACCOUNT, importer.DUPLICATE_KEY, importer.DUPLICATE_KEY]
    assert [r["row"] for r in json.loads(result.rejections)] == [1, 2, 3]


def test_first_reason_wins_and_invalid_twin_poisons(spark, sample):
    rows = [
        {**PAYLOAD[0], "account_number": "?", "cost_center_code": "?"},
        {**PAYLOAD[0], "cost_center_code": "?"},
        {**PAYLOAD[0], "fiscal_month": 13},
        {k: v for k, v in PAYLOAD[1].items() if k != "original_amount"},
        PAYLOAD[1],
        PAYLOAD[2],
    ]
    assert reasons(spark, sample, rows) == [
        importer.UNKNOWN_ACCOUNT, importer.UNKNOWN_COST_CENTER, importer.NO_PERIOD, importer.MISSING_FIELDS,
        importer.DUPLICATE_KEY, None]


def test_duplicates_across_payloads_of_a_budget(spark, sample):
    assert reasons(spark, sample, PAYLOAD[:1], PAYLOAD[:1]) == [importer.DUPLICATE_KEY] * 2


def test_ambiguous_code_stays_unresolved(spark, sample):
    twice = sample["GLAccount"].unionByName(sample["GLAccount"].where("AccountNumber = '4000'"))
    rows = importer.import_resolve_keys(
        importer.import_payload_rows(payloads(spark, PAYLOAD)), twice, sample["CostCenter"], sample["FiscalPeriod"])
    assert rows.where("GLAccountID IS NULL").count() == 1


def test_updated_lines_share_a_broken_natural_key(spark, sample):
    one, _ = imported(spark, sample, sample["BudgetLineItem"].limit(0), "UPDATE", PAYLOAD)
    two = one.unionByName(one)
    after, result = imported(spark, sample, two, "UPDATE", [{**PAYLOAD[0], "original_amount": 1}])
    assert result.rows_updated == 1
    assert after.where("OriginalAmount = 1").count() == 2


def test_spread_method_is_kept_when_missing(spark, sample):
    one, _ = imported(spark, sample, sample["BudgetLineItem"].limit(0), "UPDATE", PAYLOAD)
    after, _ = imported(spark, sample, one, "UPDATE", [{**PAYLOAD[0], "spread_method_code": None}])
    assert after.where("SpreadMethodCode = 'EVEN'").count() == 3


def test_other_mode_raises_on_a_missing_amount(spark, sample):
    rows = [{**PAYLOAD[0], "original_amount": None}]
    assert reasons(spark, sample, rows, mode="NONE") == [None]
    ledger, _ = importer.run_import(
        payloads(spark, rows), sample["BudgetLineItem"], sample["GLAccount"], sample["CostCenter"],
        sample["FiscalPeriod"], "batch", NOW, validation_mode="NONE", new_id="1")
    with pytest.raises(Exception, match="required column"):
        ledger.collect()


def test_handling_is_checked(spark, sample):
    with pytest.raises(ValueError, match="REJECT or UPDATE"):
        imported(spark, sample, sample["BudgetLineItem"], "IGNORE", PAYLOAD)


def test_payload_shapes(spark):
    rows = importer.import_payload_rows(
        payloads(spark, [{"account_number": 4000, "fiscal_year": "2024"}, "text", None], None, "[]", "5")).collect()
    assert [(r.row_id, r.account_number, r.fiscal_year) for r in rows] == [(1, "4000", 2024), (2, None, None), (3, None, None)]
    with pytest.raises(Exception, match="MALFORMED"):
        importer.import_payload_rows(payloads(spark, "[{")).collect()


def test_lists_at_most_a_hundred_rejections(spark, sample):
    _, result = imported(spark, sample, sample["BudgetLineItem"], "REJECT", [BAD[0]] * 130)
    listed = json.loads(result.rejections)
    assert result.rows_rejected == 130 and [r["row"] for r in listed] == list(range(1, 101))
