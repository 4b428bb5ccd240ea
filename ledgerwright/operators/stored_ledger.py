"""Changes to a stored ledger that read and rewrite only the folders they touch.

The ledger is stored in folders by budget and period (``files.FOLDERS``). The scan is
pruned to the range of the wanted folders, and joined to them; the new rows are stored beside the
ledger before they replace those folders, so a failed run leaves the old ones.
One writer per folder at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwright.functions.stored import materialize
from ledgerwright.operators import importer, period
from ledgerwright.sources import files, versions

LEDGER = "BudgetLineItem"


def touched(ledger: DataFrame, keys: DataFrame) -> DataFrame:
    """The ledger rows of the folders named by ``keys``, which has all or some of the folder columns."""
    columns = [c for c in files.FOLDERS[LEDGER] if c in keys.columns]
    wanted = keys.select(*columns).distinct()
    bounds = wanted.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]).first()
    in_range = [F.col(c).between(F.lit(bounds[f"min_{c}"]), F.lit(bounds[f"max_{c}"])) for c in columns]
    return ledger.where(reduce(Column.__and__, in_range)).join(wanted, columns, "left_semi").select(*ledger.columns)


def close_lines(spark: SparkSession, root: str, closing: DataFrame, now: str) -> None:
    """Mark every line of the given periods allocated, in their folders only."""
    part = touched(files.read_table(spark, root, LEDGER), closing)
    files.replace_folders(materialize(period.close_lines(part, closing), "closed"), root, LEDGER, now)


def run_import(
    spark: SparkSession,
    root: str,
    payloads: DataFrame,
    accounts: DataFrame,
    centers: DataFrame,
    periods: DataFrame,
    batch_id: str,
    now: str,
    duplicate_handling: str = "REJECT",
    validation_mode: str = "STRICT",
) -> DataFrame:
    """Import payloads into the stored ledger; the result per budget.

    Existing lines are looked up in the folders that the payloads name, and only
    folders that get a new or a changed line are rewritten.
    """
    ledger = files.read_table(spark, root, LEDGER)
    resolved = importer.import_resolve_keys(importer.import_payload_rows(payloads), accounts, centers, periods)
    resolved = materialize(resolved, "resolved")
    known = touched(ledger, resolved)
    validated = materialize(
        importer.import_validate(resolved, known, duplicate_handling, validation_mode, stored=True), "validated"
    )
    part = touched(ledger, validated.where("is_valid"))
    after = importer.import_apply(part, validated, batch_id, now, duplicate_handling)
    files.replace_folders(materialize(after, "imported"), root, LEDGER, now)
    return importer.import_result(validated, batch_id, duplicate_handling)


def close_published(spark: SparkSession, root: str, closing: DataFrame, run_id: str, now: str) -> int:
    """``close_lines`` as one new version of the ledger; its number."""
    snapshot = versions.read_version(spark, root, LEDGER)
    # Published folders are beside those that are read, so the rows need no other store.
    closed = period.close_lines(touched(snapshot.rows, closing), closing)
    return versions.publish(closed, root, LEDGER, now, run_id, closing, snapshot)


def import_published(
    spark: SparkSession,
    root: str,
    payloads: DataFrame,
    accounts: DataFrame,
    centers: DataFrame,
    periods: DataFrame,
    batch_id: str,
    now: str,
    duplicate_handling: str = "REJECT",
    validation_mode: str = "STRICT",
) -> DataFrame:
    """``run_import`` as one new version of the ledger; the result per budget.

    Refused with ``versions.Conflict`` if another run changed a folder in which keys were
    looked up: two imports of a budget cannot both insert a line.
    """
    snapshot = versions.read_version(spark, root, LEDGER)
    resolved = importer.import_resolve_keys(importer.import_payload_rows(payloads), accounts, centers, periods)
    resolved = materialize(resolved, "resolved")
    known = touched(snapshot.rows, resolved)
    validated = materialize(
        importer.import_validate(resolved, known, duplicate_handling, validation_mode, stored=True), "validated"
    )
    part = touched(snapshot.rows, validated.where("is_valid"))
    after = materialize(importer.import_apply(part, validated, batch_id, now, duplicate_handling), "imported")
    versions.publish(after, root, LEDGER, now, batch_id, resolved, snapshot)
    return importer.import_result(validated, batch_id, duplicate_handling)
