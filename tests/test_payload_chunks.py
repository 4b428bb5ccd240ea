"""Chunked payloads: every cut gives the elements of the whole array."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerwright.operators import importer, payload_chunks

SCHEMA = "payload_id string, BudgetHeaderID long, block long, chunk long, data binary"
ELEMENT = {"account_number": '40"0,\\]', "notes": "é\\\"[{,", "deep": [[1, {"a": "]"}], "\\"], "fiscal_year": 2024}
PAYLOAD = json.dumps([ELEMENT, "a,b", None, 5, {"account_number": "\\\\"}, [1, 2], {}], ensure_ascii=False)


def rows(spark, chunks):
    frame = spark.createDataFrame(chunks, SCHEMA)
    return sorted((r.payload_id, r.row_id, json.dumps(json.loads(r.element))) for r in payload_chunks.payload_elements(frame).collect())


def whole(payloads):
    return sorted((p, k + 1, json.dumps(e)) for p, text in payloads.items() for k, e in enumerate(json.loads(text)))


def test_a_cut_at_every_byte(spark):
    """One payload for each place to cut, one with a chunk for each byte, and empty chunks."""
    data = PAYLOAD.encode()
    payloads = {f"cut{k:03}": PAYLOAD for k in range(len(data) + 1)} | {"bytes": PAYLOAD, "empty": "[]", "blank": " [ \n] "}
    chunks = []
    for k in range(len(data) + 1):
        chunks += [(f"cut{k:03}", 1, 0, 0, data[:k]), (f"cut{k:03}", 1, k % 2, 1, data[k:])]
    chunks += [("bytes", 1, k // 7, k, data[k : k + 1]) for k in range(len(data))] + [("bytes", 1, 999, 5000, None)]
    chunks += [("empty", 1, 0, 0, b"["), ("empty", 1, 0, 1, b"]"), ("blank", 1, 0, 0, b" [ \n] ")]
    assert rows(spark, chunks) == whole(payloads)


@pytest.mark.parametrize("seed", range(3))
def test_random_payloads_and_cuts(spark, seed):
    rng = random.Random(seed)

    def value(depth):
        kind = rng.randrange(6 if depth < 3 else 3)
        text = "".join(rng.choices('ab"\\[]{},: é\n', k=rng.randint(0, 6)))
        if kind == 3:
            return {text: value(depth + 1)}
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        return [text, rng.randint(-5, 5), None][kind % 3]

    payloads, chunks = {}, []
    for p in range(40):
        text = json.dumps([value(0) for _ in range(rng.randint(0, 8))], ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        payloads[f"p{p}"], data, low, k = text, text.encode(), 0, 0
        while low < len(data):
            high = low + rng.randint(1, 12)
            chunks.append((f"p{p}", 1, k // 4, k, data[low:high]))
            low, k = high, k + 1
    rng.shuffle(chunks)
    assert rows(spark, chunks) == whole(payloads)


def test_typed_rows_as_of_the_whole_payload(spark):
    data = PAYLOAD.encode()
    chunks = spark.createDataFrame([("p", 7, 0, k, data[k * 9 : k * 9 + 9]) for k in range(len(data) // 9 + 1)], SCHEMA)
    one = spark.createDataFrame([("p", 7, PAYLOAD)], "payload_id string, BudgetHeaderID long, payload string")
    expected = importer.import_payload_rows(one)
    found = payload_chunks.import_chunk_rows(chunks)
    assert found.dtypes == expected.dtypes
    assert sorted(found.collect(), key=lambda r: r.row_id) == sorted(expected.collect(), key=lambda r: r.row_id)


@pytest.mark.parametrize("text", ['[{"a": 1}', '["a]', "[1, 2]]", '{"a": 1}', "[1] 2", "[1,]", "[tru]"])
def test_malformed(spark, text):
    data = text.encode()
    chunks = spark.createDataFrame([("p", 1, 0, k, data[k : k + 2]) for k in range(0, len(data), 2)], SCHEMA)
    with pytest.raises(Exception, match="MALFORMED"):
        payload_chunks.import_chunk_rows(chunks).collect()


def test_a_file_of_one_line_is_read_by_many_tasks(spark, tmp_path):
    rows_ = [{"account_number": str(k), "notes": "x, y" * (k % 5)} for k in range(20_000)]
    (tmp_path / "p.json").write_text(json.dumps(rows_))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        chunks = payload_chunks.read_payload_chunks(spark, str(tmp_path), budget=3, commas=500)
        assert chunks.agg(F.count_distinct("block")).first()[0] > 5
        found = payload_chunks.import_chunk_rows(chunks).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.row_id, r.account_number, r.notes) for r in found) == [
        (k + 1, r["account_number"], r["notes"]) for k, r in enumerate(rows_)
    ]
    assert {r.BudgetHeaderID for r in found} == {3}


def test_the_elements_of_one_payload_stay_in_many_tasks(spark):
    """Also where no side of a join is small enough to be sent to all tasks."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    elements = 400
    data = ("[" + ",".join(f'{{"a": {k}}}' for k in range(elements)) + "]").encode()
    chunks = [("p", 1, k // 100, k // 50, data[k : k + 50]) for k in range(0, len(data), 50)]
    try:
        for key, value in zip(before, ("false", "-1", "8"), strict=True):
            spark.conf.set(key, value)
        found = payload_chunks.payload_elements(spark.createDataFrame(chunks, SCHEMA))
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(tasks) == elements and max(tasks) < elements / 2
