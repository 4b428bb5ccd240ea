"""Published changes of a stored ledger: seen at once, refused after a newer change, invisible until marked."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from sample_ledger import NOW
from test_import import BAD, PAYLOAD, payloads

from ledgerwright.operators import importer, period, stored_ledger
from ledgerwright.sources import files, versions

LEDGER = stored_ledger.LEDGER


def rows(spark, root, version=None):
    return sorted(map(str, versions.read_version(spark, root, LEDGER, version).rows.collect()))


@pytest.fixture
def root(sample, tmp_path):
    files.write_table(sample[LEDGER], str(tmp_path), LEDGER, NOW)
    return str(tmp_path)


def publish_import(spark, root, sample, batch, handling="REJECT"):
    return stored_ledger.import_published(
        spark, root, payloads(spark, PAYLOAD, BAD), sample["GLAccount"], sample["CostCenter"], sample["FiscalPeriod"],
        batch, NOW, handling).first()


def test_every_version_stays_readable(spark, sample, root):
    before = rows(spark, root)
    closing = spark.createDataFrame([(3,), (99,)], "FiscalPeriodID bigint")
    assert stored_ledger.close_published(spark, root, closing, "close-1", NOW) == 1
    closed = versions.read_version(spark, root, LEDGER)
    want = period.close_lines(files.read_table(spark, root, LEDGER), closing)
    assert rows(spark, root) == sorted(map(str, want.select(*closed.rows.columns).collect())) != before
    result = publish_import(spark, root, sample, "batch-1")
    _, expected = importer.run_import(
        payloads(spark, PAYLOAD, BAD), sample[LEDGER], sample["GLAccount"], sample["CostCenter"], sample["FiscalPeriod"],
        "batch-1", NOW, "REJECT")
    assert result == expected.first() and result.rows_inserted > 0
    assert versions.last_version(spark, root, LEDGER) == 2
    assert len(rows(spark, root)) == len(before) + result.rows_inserted
    assert rows(spark, root, 1) == sorted(map(str, closed.rows.collect())) and rows(spark, root, 0) == before


def test_a_run_that_fails_between_two_folders_is_not_seen(spark, sample, root):
    before = rows(spark, root)
    snapshot = versions.read_version(spark, root, LEDGER)
    part = snapshot.rows.where("FiscalPeriodID IN (3, 4)").withColumn("IsAllocated", F.lit(True))
    breaks = part.withColumn("RowHash", F.expr("IF(FiscalPeriodID = 4, raise_error('lost'), RowHash)"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(breaks, root, LEDGER, NOW, "run", part, snapshot)
    assert rows(spark, root) == before and versions.last_version(spark, root, LEDGER) == 0
    # All folders written, but no marker.
    files.write_folders(part, f"{root}/{LEDGER}_changes/{files.RUN_COLUMN}=run", LEDGER, NOW)
    assert rows(spark, root) == before
    assert versions.publish(part, root, LEDGER, NOW, "run", part, snapshot) == 1
    assert rows(spark, root) != before and len(rows(spark, root)) == len(before)


def test_a_writer_whose_folders_changed_is_refused(spark, sample, root):
    snapshot = versions.read_version(spark, root, LEDGER)
    first = snapshot.rows.where("FiscalPeriodID = 3").withColumn("IsAllocated", F.lit(True))
    other = snapshot.rows.where("FiscalPeriodID = 4").withColumn("IsAllocated", F.lit(True))
    assert versions.publish(first, root, LEDGER, NOW, "a", first, snapshot) == 1
    with pytest.raises(versions.Conflict):
        versions.publish(first, root, LEDGER, NOW, "b", first, snapshot)
    with pytest.raises(versions.Conflict):  # it writes another folder, but has read this one
        versions.publish(other, root, LEDGER, NOW, "c", snapshot.rows.where("FiscalPeriodID = 3"), snapshot)
    assert versions.publish(other, root, LEDGER, NOW, "d", other, snapshot) == 2
    closed = versions.read_version(spark, root, LEDGER).rows.where("IsAllocated AND FiscalPeriodID IN (3, 4)")
    assert closed.count() == first.count() + other.count()


def test_two_imports_cannot_both_insert_a_line(spark, sample, root, monkeypatch):
    read, result = versions.read_version, {}

    def late(spark_, root_, name, version=None):
        """The second import reads before the first one has published."""
        snapshot = read(spark_, root_, name, version)
        if not result:
            result["first"] = None
            result["first"] = publish_import(spark, root, sample, "first")
        return snapshot

    monkeypatch.setattr(versions, "read_version", late)
    with pytest.raises(versions.Conflict):
        publish_import(spark, root, sample, "second")
    assert result["first"].rows_inserted > 0
    again = publish_import(spark, root, sample, "third")
    assert again.rows_inserted == 0
    ledger = read(spark, root, LEDGER).rows
    assert ledger.groupBy("BudgetHeaderID", "GLAccountID", "CostCenterID", "FiscalPeriodID").count().where("count > 1").isEmpty()


def test_a_taken_number_is_not_overwritten(spark, sample, root, tmp_path):
    for name in ("a", "b"):
        spark.range(1).write.parquet(str(tmp_path / name))
    assert versions._moved(spark, str(tmp_path / "a"), str(tmp_path / "v" / "version=1"))
    assert not versions._moved(spark, str(tmp_path / "b"), str(tmp_path / "v" / "version=1"))
    assert (tmp_path / "b").exists()
