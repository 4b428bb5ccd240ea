"""Queries over large tables: partitions follow the number of rows, and what is read again is stored once."""

from __future__ import annotations

import time

import pytest

from ledgerwright.functions import numbering, stored
from ledgerwright.operators import importer, stored_ledger
from ledgerwright.plans import queries
from ledgerwright.sources import retail

PARTITIONS = "spark.sql.shuffle.partitions"
TABLES = {
    "region": (1, ["CAST(id AS INT) AS r_regionkey", "'AFRICA' AS r_name"]),
    "nation": (2, ["CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name", "0 AS n_regionkey"]),
    "supplier": (4, ["id AS s_suppkey", "concat('S', id) AS s_name", "CAST(id % 2 AS INT) AS s_nationkey", "1.5D AS s_acctbal"]),
    "part": (6, ["id AS p_partkey", "concat('part ', id) AS p_name", "'B' AS p_brand", "'ECONOMY' AS p_type",
                 "CAST(id AS INT) AS p_size", "1D AS p_retailprice"]),
    "orders": (20, ["id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "1D AS o_totalprice",
                    "add_months(TIMESTAMP_NTZ'1996-11-01 00:00:00', CAST(id % 5 AS INT)) + INTERVAL '0' SECOND AS o_orderdate",
                    "'LOW' AS o_orderpriority"]),
    "lineitem": (60, ["id % 20 AS l_orderkey", "id % 6 AS l_partkey", "id % 4 AS l_suppkey",
                      "CAST(id DIV 20 AS INT) AS l_linenumber", "CAST(id % 7 AS DOUBLE) AS l_quantity",
                      "100D + id AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax",
                      "substr('RNA', CAST(id % 3 AS INT) + 1, 1) AS l_returnflag", "IF(id % 2 = 0, 'F', 'O') AS l_linestatus"]),
    "events": (5, ["id AS event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id AS user_id", "1D AS value"]),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, (n, columns) in TABLES.items():
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_partitions_follow_rows_and_are_put_back(spark, monkeypatch):
    monkeypatch.setattr(stored, "ROWS_A_TASK", 10)
    before = spark.conf.get(PARTITIONS)
    with pytest.raises(KeyError), stored.sized(spark, 10 * int(before) + 1):
        assert spark.conf.get(PARTITIONS) == str(int(before) + 1)
        raise KeyError
    with stored.sized(spark, 1):
        assert spark.conf.get(PARTITIONS) == before
    assert spark.conf.get(PARTITIONS) == before


def test_a_large_ledger_is_grouped_in_more_partitions(spark, folder, monkeypatch):
    small = sorted(retail.budget_lines(spark, folder).collect())
    monkeypatch.setattr(stored, "ROWS_A_TASK", 1)
    ledger = retail.budget_lines(spark, folder)
    summary = queries.QUERIES["budget_consolidation_summary"](spark, folder)
    for frame in (ledger, summary):
        assert "REPARTITION_BY_NUM" in frame._jdf.queryExecution().executedPlan().toString()
    assert sorted(ledger.collect()) == small
    assert summary.count() == len(small)


@pytest.mark.parametrize("name", ["import_validate", "import_apply", "import_result", "import_apply_stored"])
def test_imports_store_with_partitions_for_their_rows(spark, folder, monkeypatch, name):
    expected = sorted(map(str, queries.QUERIES[name](spark, folder).collect()))
    seen = []
    for module in (importer, stored_ledger):
        def recorded(df, label):
            seen.append((label, int(spark.conf.get(PARTITIONS))))
            return stored.materialize(df, label)

        monkeypatch.setattr(module, "materialize", recorded)
    monkeypatch.setattr(stored, "ROWS_A_TASK", 2)
    before = spark.conf.get(PARTITIONS)
    found = sorted(map(str, queries.QUERIES[name](spark, folder).collect()))
    assert found == expected
    assert min(n for _, n in seen) >= 30 and spark.conf.get(PARTITIONS) == before
    if name == "import_apply_stored":
        # the resolved rows are stored once
        assert [label for label, _ in seen] == ["resolved", "validated", "imported"]


def test_closed_lines_are_written_once(spark, folder, monkeypatch):
    labels = []
    monkeypatch.setattr(stored_ledger, "materialize", lambda df, label: labels.append(label) or stored.materialize(df, label))
    rows = queries.QUERIES["close_lines_stored"](spark, folder).collect()
    assert labels == []
    assert sorted(rows) == sorted(queries.QUERIES["close_lines"](spark, folder).collect())
    assert {r.IsAllocated for r in rows} == {True}


def test_row_parity_makes_the_ledger_once(spark, folder, monkeypatch):
    made, lines = [], retail.budget_lines
    monkeypatch.setattr(retail, "budget_lines", lambda *a, **k: made.append(a) or lines(*a, **k))
    assert queries.QUERIES["parity_rows"](spark, folder).count() > 0
    assert len(made) == 1


def test_keys_of_many_rows_are_counted_in_more_partitions(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr(stored, "ROWS_A_TASK", 2)
    monkeypatch.setattr(
        queries, "materialize", lambda df, label: seen.append(int(spark.conf.get(PARTITIONS))) or stored.materialize(df, label)
    )
    queries.QUERIES["audit_unique"](spark, folder).collect()
    assert seen and min(seen) >= 120


def test_cost_centers_are_not_sent_to_all_tasks_for_rule_targets(spark, folder):
    """Their files say little about their size in memory, also where these are below the broadcast threshold."""
    targets = queries.QUERIES["allocation_rule_targets"](spark, folder)
    assert "Broadcast" not in targets._jdf.queryExecution().executedPlan().toString()
    rows = targets.collect()
    assert "Broadcast" not in targets._jdf.queryExecution().executedPlan().toString()
    assert rows and {r.RuleIsActive for r in rows} == {True}


@pytest.mark.parametrize("name", ["import_validate", "import_apply", "import_result"])
def test_large_imports_go_slice_by_slice(spark, folder, monkeypatch, tmp_path, name):
    """The same rows, and what was resolved is not kept beside what was judged."""
    expected = sorted(map(str, queries.QUERIES[name](spark, folder).collect()))
    monkeypatch.setattr(stored, "ROWS_A_SLICE", 10, raising=False)
    monkeypatch.setattr(stored, "shared_folder", lambda spark: str(tmp_path))
    found = queries.QUERIES[name](spark, folder)
    assert sorted(map(str, found.collect())) == expected
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["judged"]


def test_slices_keep_repeated_and_null_keys_together(spark):
    keys = [(1, 2, 3, 4), (1, 2, 3, 5), (1, None, 3, 4), (None, None, None, None)]
    rows = [(p, *keys[k % 4], k % 3) for k, p in enumerate([None, "a", "b", "a", "c", "c", "d", None, "e", "f"] * 3)]
    rows.append(("z", 9, 9, 9, 9, 1))
    names = "payload_id string, " + ", ".join(f"{k} long" for k in importer.KEYS)
    resolved = spark.createDataFrame(rows, f"{names}, original_amount int")
    ledger = spark.createDataFrame([(1, 2, 3, 5), (9, 9, 9, 9), (9, 9, 9, 9), (7, None, 7, 7)], ", ".join(f"{k} long" for k in importer.KEYS))
    for handling in importer.DUPLICATE_HANDLING:
        whole = importer.import_validate(resolved, ledger, handling)
        sliced = importer.import_validate(resolved, ledger, handling, slices=3)
        assert sliced.dtypes == whole.dtypes
        assert sorted(map(str, sliced.collect())) == sorted(map(str, whole.collect()))


def test_a_stored_step_leaves_no_shuffle_files(spark):
    """They took the disk until the session's end, beside those of the next steps."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def written():
        return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    before = written()
    rows = stored.materialize(spark.range(1000).selectExpr("id % 7 AS k", "id").repartition(5, "k"), "rows")
    until = time.monotonic() + 10
    while written() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not written() - before
    assert rows.count() == 1000


def test_chunked_payloads_store_what_is_read_again(spark, folder, monkeypatch, tmp_path):
    """Of the lines only what elements have, and no chunks once they are cut."""
    expected = sorted(map(str, queries.QUERIES["import_chunk_rows"](spark, folder).collect()))
    monkeypatch.setattr(stored, "shared_folder", lambda spark: str(tmp_path))
    assert sorted(map(str, queries.QUERIES["import_chunk_rows"](spark, folder).collect())) == expected
    assert not list(tmp_path.glob("payload-chunks-*"))
    (numbered,) = tmp_path.glob("numbered-*")
    assert not {"l_shipdate", "l_linestatus", "l_extendedprice"} & set(spark.read.parquet(str(numbered)).columns)


def test_numbered_rows_do_not_move_to_meet_few_offsets(spark):
    rows = numbering.number_rows(spark.range(5000).selectExpr("id % 3 AS g", "id"), ["g"], ["id"], "n")
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    found = {(r.g, r.id): r.n for r in rows.collect()}
    assert found == {(k % 3, k): k // 3 + 1 for k in range(5000)}
