import json
from decimal import Decimal

import pytest
from sample_ledger import NOW

from ledgerwright import schemas as S
from ledgerwright.operators import audit, parity

SPEC = {"tables": [{"name": "T", "key": "id", "columns": [{"name": "amount", "kind": "numeric"}, "name"]}]}


def side(spark, *rows, types="amount decimal(19,5), name string"):
    return {"T": spark.createDataFrame([(Decimal(a) if a is not None else None, n) for a, n in rows], types)}


def diffs(spark, source, target):
    result = parity.run_parity(spark, parity.read_spec(SPEC), source, target)
    return {r.metric: r for r in parity.parity_diff(result).collect()}


def test_spec_defaults_and_errors(tmp_path):
    found = parity.read_spec({"tables": [{"name": "T", "columns": ["Name", {"name": "A", "kind": "numeric"}]}]})["T"]
    assert [(m.metric, m.scale) for m in found] == [
        ("row_count", 4), ("name__count", 4), ("name__min", 4), ("name__max", 4),
        ("a__count", 4), ("a__sum", 4), ("a__min", 4), ("a__max", 4)]
    for bad, message in (
        ({"tables": []}, "no tables"),
        (None, "no tables"),
        ({"tables": [{"columns": []}]}, "no name"),
        ({"tables": [{"name": "T", "columns": [{"kind": "text"}]}]}, "no name"),
        ({"tables": [{"name": "T", "columns": [{"name": "C", "kind": "blob"}]}]}, "kind must be"),
    ):
        with pytest.raises(parity.SpecError, match=message):
            parity.read_spec(bad)
    (tmp_path / "bad.json").write_text("{")
    for path, message in (("gone.json", "no parity spec"), ("bad.json", "cannot be read")):
        with pytest.raises(parity.SpecError, match=message):
            parity.read_spec(tmp_path / path)
    (tmp_path / "spec.json").write_text(json.dumps(SPEC))
    assert parity.read_spec(tmp_path / "spec.json") == parity.read_spec(SPEC)


def test_spec_covers_every_core_table():
    spec = parity.read_spec(parity.PLANNING_SPEC)
    assert list(spec) == [t.name for t in S.CORE_TABLES]
    for table, found in spec.items():
        assert {m.column for m in found if m.column} <= set(S.TABLES[table].schema.names)
    assert sum(map(len, spec.values())) == 97


def test_equal_sides(spark):
    one = side(spark, ("1.5", "a"), (None, None))
    assert diffs(spark, one, one) == {}
    metrics = parity.run_parity(spark, parity.read_spec(SPEC), one, one).source.collect()
    assert {m.metric: m.text for m in metrics} == {
        "row_count": "2", "amount__count": "1", "amount__sum": "1.5", "amount__min": "1.5", "amount__max": "1.5",
        "name__count": "1", "name__min": "a", "name__max": "a"}


def test_scale_and_blanks_do_not_count(spark):
    assert diffs(spark, side(spark, ("5000", "alpha   ")),
                 side(spark, ("5000.0000", "alpha"), types="amount decimal(19,4), name string")) == {}
    assert diffs(spark, side(spark, ("5000.00001", "a")), side(spark, ("5000.00002", "a"))) == {}


def test_differences(spark):
    found = diffs(spark, side(spark, ("5000.55", "alphabet"), ("0", "b")), side(spark, ("5000", "alpha")))
    assert (found["amount__sum"].delta, found["amount__sum"].source) == ("0.55", "5000.55")
    assert (found["name__min"].source, found["name__min"].target, found["name__min"].delta) == ("alphabet", "alpha", "")
    assert found["row_count"].delta == "1"
    assert diffs(spark, side(spark, ("1.00", "a")), side(spark, ("1.01", "a")))["amount__sum"].delta == "0.01"
    assert diffs(spark, side(spark, ("1", "a")), side(spark, ("1", None)))["name__min"].target == "NULL"


def test_a_bad_table_does_not_stop_the_others(spark, sample):
    tables = {"CostCenter": sample["CostCenter"], "GLAccount": sample["GLAccount"]}
    checks = parity.read_spec({"tables": [
        {"name": "CostCenter", "columns": [{"name": "AllocationPercentage", "kind": "numeric"}]},
        {"name": "GLAccount", "columns": ["AccountNumber"]},
        {"name": "Missing", "columns": ["x"]},
    ]})
    result = parity.run_parity(spark, checks, tables, tables)
    report = {r.table: r for r in parity.parity_report(result).collect()}
    assert "AllocationPercentage" in report["CostCenter"].error and len(report["CostCenter"].error) <= 200
    assert "Missing" in report["Missing"].error and report["GLAccount"].matched
    overall = parity.parity_ok(parity.parity_report(result)).first()
    assert (overall.matched, overall.errored, overall.tables, overall.ok) == (1, 2, 3, False)
    assert parity.parity_ok(parity.parity_report(parity.run_parity(spark, {}, {}, {}))).first().ok


def test_what_fails_while_running_is_the_tables_error(spark, tmp_path):
    (tmp_path / "torn").mkdir()
    (tmp_path / "torn" / "part-0.parquet").write_bytes(b"PAR1 no parquet PAR1")
    wide = spark.sql("SELECT CAST(9e37 AS DECIMAL(38,0)) AS a FROM range(3)")
    tables = {"Wide": wide, "Torn": spark.read.schema("a long").parquet(str(tmp_path / "torn")),
              "Good": spark.sql("SELECT CAST(1 AS DECIMAL(38,12)) AS a")}
    spec = parity.read_spec({"tables": [
        {"name": n, "columns": [{"name": "a", "kind": "numeric", "scale": 12 if n == "Good" else 0}]} for n in tables]})
    report = {r.table: r for r in parity.parity_report(parity.run_parity(spark, spec, tables, tables)).collect()}
    assert report["Wide"].error and report["Torn"].error and not report["Wide"].matched
    assert report["Good"].matched and report["Good"].error == ""


def test_declared_scale_and_all_blanks(spark):
    spec = parity.read_spec({"tables": [{"name": "T", "columns": [{"name": "a", "kind": "numeric", "scale": 12}, "n"]}]})
    one = {"T": spark.sql("SELECT 0.000000000001BD AS a, 'x\u00a0' AS n")}
    two = {"T": spark.sql("SELECT 0.000000000004BD AS a, 'x' AS n")}
    found = parity.parity_diff(parity.run_parity(spark, spec, one, two), Decimal("1e-12")).collect()
    assert {(r.metric, r.delta) for r in found} == {(f"a__{h}", "0.000000000003") for h in ("sum", "min", "max")}


def test_dropping_a_row_is_found(spark, sample):
    tables = {n: df for n, df in sample.items()}
    checks = {t: m for t, m in parity.read_spec(parity.PLANNING_SPEC).items() if t in tables}
    copy = {**tables, "BudgetLineItem": tables["BudgetLineItem"].orderBy("BudgetLineItemID").limit(249)}
    assert parity.parity_diff(parity.run_parity(spark, checks, tables, tables)).isEmpty()
    found = parity.parity_diff(parity.run_parity(spark, checks, tables, copy)).collect()
    assert {r.table for r in found} == {"BudgetLineItem"} and "row_count" in {r.metric for r in found}


def test_constraint_counts():
    tables = S.TABLES.values()
    assert sum(bool(t.primary_key) for t in tables) == 11
    assert sum(len(t.unique) for t in tables) == 8
    assert sum(len(t.foreign_keys) for t in tables) == 20
    assert sum(len(t.checks) for t in tables) == 10


def test_sample_passes_its_audits(sample):
    assert audit.audit_unique(sample).isEmpty()
    assert audit.audit_foreign_keys(sample).isEmpty()
    assert audit.audit_checks(sample).isEmpty()
    assert audit.audit_not_null(sample).where("null_count > 0").isEmpty()


def test_audits_find_what_is_broken(sample):
    broken = dict(sample)
    broken["GLAccount"] = sample["GLAccount"].where("GLAccountID <> 1").selectExpr(
        *["'4100'" + " AS AccountNumber" if c == "AccountNumber" else
          "CASE WHEN GLAccountID = 2 THEN 'Z' WHEN GLAccountID = 3 THEN NULL ELSE AccountType END AS AccountType"
          if c == "AccountType" else c for c in sample["GLAccount"].columns])
    assert [(r.constraint_name, r.key, r.copies) for r in audit.audit_unique(broken).collect()] == [
        ("UQ_GLAccount_Number", "4100", 19)]
    orphans = audit.audit_foreign_keys(broken).collect()
    used = sample["BudgetLineItem"].where("GLAccountID = 1").count()
    assert [(r.constraint_name, r.key, r.orphan_rows) for r in orphans] == [("FK_BudgetLineItem_Account", "1", used)]
    assert [(r.constraint_name, r.row_key) for r in audit.audit_checks(broken).collect()] == [("CK_GLAccount_Type", "2")]
    nulls = audit.audit_not_null(broken).where("null_count > 0").collect()
    assert [(r.column_name, r.row_count, r.null_count) for r in nulls] == [("AccountType", 19, 1)]


def test_invariants(spark, sample):
    line = spark.createDataFrame([(1, 1, 5, 2, 3), (2, 1, 0, 3, 3), (3, 2, 4, 0, 4), (4, 2, 0, 4, -4)],
                                 "JournalLineID bigint, JournalID bigint, d int, c int, n int").selectExpr(
        "JournalLineID", "JournalID", "CAST(d AS DECIMAL(19,4)) AS DebitAmount",
        "CAST(c AS DECIMAL(19,4)) AS CreditAmount", "CAST(n AS DECIMAL(19,4)) AS NetAmount")
    journal = S.complete(spark.createDataFrame([(1, False), (2, False), (3, True)], "JournalID bigint, IsBalanced boolean"),
                         S.CONSOLIDATION_JOURNAL, NOW)
    headers = sample["BudgetHeader"].selectExpr(
        *["BudgetHeaderID = 2 AS IsLocked" if c == "IsLocked" else c for c in sample["BudgetHeader"].columns])
    found = audit.audit_invariants(sample["BudgetLineItem"], journal, line, headers).collect()
    rest = {(r.table_name, r.invariant, r.row_key) for r in found if r.table_name != "BudgetLineItem"}
    assert rest == {
        ("ConsolidationJournalLine", "net = debit - credit", "2"),
        ("ConsolidationJournal", "balanced = debits equal credits", "1"),
        ("ConsolidationJournal", "balanced = debits equal credits", "2"),
        ("ConsolidationJournal", "total debits = sum of lines", "1"),
        ("ConsolidationJournal", "total credits = sum of lines", "1"),
        ("ConsolidationJournal", "total debits = sum of lines", "2"),
        ("ConsolidationJournal", "total credits = sum of lines", "2"),
        ("BudgetHeader", "locked = status is LOCKED", "2"),
    }
    # adjusted and final amounts of the sample are drawn apart
    assert sum(r.table_name == "BudgetLineItem" for r in found) > 200
