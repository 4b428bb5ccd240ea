import contextlib
import io
import os
import re

from sample_ledger import NOW
from test_import import BAD, PAYLOAD, payloads

from ledgerwright.operators import importer, stored_ledger
from ledgerwright.sources import files

LEDGER = stored_ledger.LEDGER


def kept_files(root):
    return {
        os.path.relpath(os.path.join(folder, f), root)
        for folder, _, names in os.walk(os.path.join(root, LEDGER)) for f in names if f.endswith(".parquet")}


def folders(paths):
    return {os.path.basename(os.path.dirname(p)) for p in paths}


def shown(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_only_touched_folders_are_read_and_rewritten(spark, sample, tmp_path):
    root = str(tmp_path)
    files.write_table(sample[LEDGER], root, LEDGER, NOW)
    before, whole = kept_files(root), files.read_table(spark, root, LEDGER).count()
    closing = spark.createDataFrame([(3,), (99,)], "FiscalPeriodID bigint")
    part = stored_ledger.touched(files.read_table(spark, root, LEDGER), closing)
    assert re.search(r"PartitionFilters: \[.*FiscalPeriodID#\w+ >= 3", shown(part))
    stored_ledger.close_lines(spark, root, closing, NOW)
    after = kept_files(root)
    assert folders(before - after) == folders(after - before) == {"FiscalPeriodID=3"}
    ledger = files.read_table(spark, root, LEDGER)
    assert ledger.count() == whole
    assert ledger.where("IsAllocated").count() == ledger.where("FiscalPeriodID = 3").count() > 0

    result = stored_ledger.run_import(
        spark, root, payloads(spark, PAYLOAD, BAD), sample["GLAccount"], sample["CostCenter"], sample["FiscalPeriod"],
        "batch", NOW, "UPDATE").first()
    _, want = importer.run_import(
        payloads(spark, PAYLOAD, BAD), sample[LEDGER], sample["GLAccount"], sample["CostCenter"],
        sample["FiscalPeriod"], "batch", NOW, "UPDATE")
    assert result == want.first()
    assert folders(after - kept_files(root)) == {"FiscalPeriodID=4"}
    ledger = files.read_table(spark, root, LEDGER)
    assert ledger.count() == whole + result.rows_inserted
    assert ledger.where("ImportBatchID = 'batch'").count() == result.rows_imported == 3
