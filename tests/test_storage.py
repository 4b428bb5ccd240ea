import random

from sample_ledger import NOW

from ledgerwright.functions.numbering import number_rows
from ledgerwright.functions.stored import SETTING, materialize, shared_folder
from ledgerwright.operators import journals
from ledgerwright.sources import files


def test_numbers_follow_the_order_in_every_group(spark):
    random.seed(3)
    # one group holds most rows, ids are sparse and partly negative
    rows = [(0 if random.random() < 0.8 else random.randint(1, 30), i * 7919 - 40000000) for i in range(12000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, id bigint").repartition(5)
    got = {(r.g, r.id): r.n for r in number_rows(df, ["g"], ["id"], "n").collect()}
    want, seen = {}, {}
    for g, i in sorted(rows):
        seen[g] = seen.get(g, 0) + 1
        want[g, i] = seen[g]
    assert got == want
    both = number_rows(df, ["g"], ["id"], "n", overall="all").orderBy("g", "id").collect()
    assert [r["all"] for r in both] == list(range(1, 12001)) and all(r.n == want[r.g, r.id] for r in both)
    flat = [r.n for r in number_rows(df, [], ["id"], "n").orderBy("id").collect()]
    assert flat == list(range(1, 12001))
    assert number_rows(df.limit(0), ["g"], ["id"], "n").collect() == []


def test_materialized_rows_live_in_the_shared_folder(spark):
    df = materialize(spark.range(10), "x")
    assert df.count() == 10 and all(shared_folder(spark).removeprefix("file:") in f for f in df.inputFiles())
    setting = spark.conf.get(SETTING, None)
    assert setting is None or shared_folder(spark) == setting.rstrip("/")


def test_tables_round_trip_and_replace_folders(spark, sample, tmp_path):
    root = str(tmp_path)
    for name, df in sample.items():
        files.write_table(df, root, name, NOW)
        back = files.read_table(spark, root, name)
        assert back.columns == df.columns and back.exceptAll(df).isEmpty() and back.count() == df.count()
    ledger = files.read_table(spark, root, "BudgetLineItem")
    first = materialize(ledger.where("FiscalPeriodID = 1").selectExpr(
        *["true AS IsAllocated" if c == "IsAllocated" else c for c in ledger.columns]), "closed")
    files.replace_folders(first, root, "BudgetLineItem", NOW)
    ledger = files.read_table(spark, root, "BudgetLineItem")
    assert ledger.count() == 250 and ledger.where("IsAllocated").count() == first.count()


def test_required_columns_are_checked_on_write(spark, sample, tmp_path):
    bad = sample["GLAccount"].selectExpr(
        *["CAST(NULL AS STRING) AS AccountNumber" if c == "AccountNumber" else c for c in sample["GLAccount"].columns])
    try:
        files.write_table(bad, str(tmp_path), "GLAccount", NOW)
    except Exception as error:
        assert "GLAccount.AccountNumber" in str(error)
    else:
        raise AssertionError("a NULL was written")


def test_a_journal_run_is_stored_whole(spark, sample, tmp_path):
    run = journals.Run(id="0" * 32, now=NOW)
    journal = journals.cost_allocation_journal(sample["BudgetHeader"], run)
    lines = journals.cost_allocation_lines(sample["BudgetLineItem"], journal, run)
    files.append_run(
        {"ConsolidationJournal": journal, "ConsolidationJournalLine": lines}, str(tmp_path), run.id, run.now)
    stored = files.read_runs(spark, str(tmp_path), "ConsolidationJournalLine")
    assert stored.select("JournalLineID").distinct().count() == 250
    assert stored.where("LocalCurrencyCode = 'USD'").count() == 250
    assert files.read_runs(spark, str(tmp_path), "ConsolidationJournal").count() == 3


def test_a_run_counts_once_it_is_committed(spark, sample, tmp_path):
    root = str(tmp_path)
    centers = sample["CostCenter"]
    files.append_run({"CostCenter": centers.limit(4)}, root, "run-1", NOW)
    # a run that failed before its marker
    centers.selectExpr("*", "'run-2' AS RunID").write.mode("append").partitionBy("RunID").parquet(
        f"{root}/CostCenter_runs")
    assert files.read_runs(spark, root, "CostCenter").count() == 4


def test_a_retried_run_is_read_once(spark, sample, tmp_path):
    root, centers = str(tmp_path), sample["CostCenter"]
    bad = centers.selectExpr(*["raise_error('lost') AS CostCenterName" if c == "CostCenterName" else c for c in centers.columns])
    files.append_run({"CostCenter": centers.limit(2)}, root, "run-0", NOW)
    try:
        files.append_run({"CostCenter": centers, "GLAccount": bad}, root, "run-1", NOW)
    except Exception:
        pass
    assert files.read_runs(spark, root, "CostCenter").count() == 2
    files.append_run({"CostCenter": centers}, root, "run-1", NOW)
    assert files.read_runs(spark, root, "CostCenter").count() == 2 + centers.count()
    try:
        files.append_run({"CostCenter": centers}, root, "run-1", NOW)
    except ValueError as error:
        assert "run-1" in str(error)
    else:
        raise AssertionError("a committed run was written again")
