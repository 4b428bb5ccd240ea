"""The pipeline's stages on the smallest test tables, and queries against their SQL."""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerwright.llm import language, packing
from ledgerwright.llm.queries import ORACLES, QUERIES
from ledgerwright.llm.shared import arrow_map
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "benchmark", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    assert difference(spark, connect(SMALL), SMALL, name, QUERIES[name], ORACLES[name]).startswith("ok")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
    whole = {r.doc_id for r in seen["language"]}
    assert len(whole) >= 195
    lines = {r.doc_id: r.text for r in seen["lines"]}
    assert set(lines) == whole and all(r.n_chars == len(r.text) for r in seen["lines"])
    kept = {r.doc_id for r in seen["near_copies"]}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for i, t in lines.items() if t.split()}
    for i in whole - kept:  # each dropped document is near one that stays, or near one that is
        assert any(len(sets[i] & s) >= 0.8 * len(sets[i] | s) for j, s in sets.items() if j != i)
    for i in kept:
        assert not any(
            j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in kept if i in sets and j in sets
        )
    assert {r.doc_id for r in seen["benchmark"]} <= kept
    chunks = packing.Chunks(packing.vocabulary())
    for r in seen["packing"]:
        text = next(x.text for x in seen["benchmark"] if x.doc_id == r.doc_id)
        ids = np.frombuffer(chunks.ids(text), "<u4").tolist() + [1]
        part = np.array(ids[r.start : r.start + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32


def test_workers_keep_no_chunks(spark):
    """Python workers serve all stages; what packing has seen once stayed in them."""
    rows = [(k, " ".join(f"word{k}x{i}" for i in range(200))) for k in range(64)]
    packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()

    def seen(batches):
        for batch in batches:
            chunks = packing._chunks(packing.vocabulary())
            yield pa.RecordBatch.from_arrays([pa.array([len(chunks) + len(chunks._pieces)] * batch.num_rows, pa.int64())], ["n"])

    assert {r.n for r in arrow_map(spark.range(64).repartition(8), seen, "n long").collect()} == {0}


def test_a_model_takes_little_room():
    """An array for each word and n-gram once took several times the room of the keys."""
    counts = {"aa": language.Counter({f"w{k}": 1 + k % 7 for k in range(5000)}), "bb": language.Counter({"v": 3})}
    scores = language._scores(counts, ["aa", "bb"], 4000)
    assert scores.get("nothing") is None and scores.get("w6").shape == (2,)
    assert len(pickle.dumps(scores)) < 4000 * 40
