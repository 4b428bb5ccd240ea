import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerwright.operators import corpus
from ledgerwright.sources import files
from ledgerwright.sources.retail import STATEMENTS


def scan(spark, *texts, severity="warning"):
    df = spark.createDataFrame([(f"f{i}.sql", t) for i, t in enumerate(texts)], "path string, text string")
    return corpus.sql_corpus_findings(df, severity)


def codes(spark, *texts, severity="warning"):
    """The codes found in each text."""
    found = [set() for _ in texts]
    for r in scan(spark, *texts, severity=severity).collect():
        found[int(r.path[1:-4])].add(r.code)
    return found


def test_every_rule_fires_on_its_statement(spark):
    found = codes(spark, *[s for _, s in STATEMENTS], "CREATE TABLE t (a SMALLINT);", severity="info")
    for (code, statement), got in zip(STATEMENTS, found):
        assert code in got or not code, statement
    assert found[-1] == {"SS102"}
    assert {r.code for r in corpus.RULES} == {c for c, _ in STATEMENTS if c} | {"SS102"}


def test_severities(spark):
    assert codes(spark, "CREATE TABLE t (a INT);") == [set()]
    assert codes(spark, "SELECT GETDATE(), LEN(x);", severity="error") == [{"SS001"}]
    assert len(corpus.rules_at("error")) == 20 and len(corpus.rules_at()) == 26 and len(corpus.rules_at("info")) == 27
    with pytest.raises(ValueError):
        corpus.rules_at("loud")


def test_comments_are_blanked_and_literals_are_not(spark):
    assert codes(
        spark,
        "-- GETDATE() was here",
        "/*\n ISNULL( \n NVARCHAR(5)\n*/",
        "/* note */ SELECT GETDATE();",
        "CREATE PROCEDURE p() AS '\n SELECT ISNULL(a, 0);\n';",
        "SELECT '--' || GETDATE()",  # a literal can start a comment
        "SELECT '/*' , GETDATE()",  # also one that never ends
        "SELECT 1 - 2 / 3, LEN(a)",
    ) == [set(), set(), {"SS001"}, {"SS003"}, set(), set(), {"SS104"}]


def test_positions(spark):
    r = scan(spark, "/* a\n   b */\r\n\r\n  SELECT x, GETDATE(), GETDATE();").collect()
    assert [(f.line, f.column, f.snippet) for f in r] == [(4, 13, "SELECT x, GETDATE(), GETDATE();")]
    wide = scan(spark, "\U0001F600\U0001F600 é GETDATE()").first()
    assert wide.column == 6
    long = scan(spark, "GETDATE()" + "x" * 5000).first()
    assert len(long.snippet) == 120


def test_word_edges_are_unicode(spark):
    assert codes(spark, "SELECT éLEN(a)", "SELECT 中MERGE x", "SELECT ısnull(a)") == [set(), set(), {"SS003"}]


def test_noqa(spark):
    line = "SELECT GETDATE(), ISNULL(a, 0);"
    assert codes(
        spark,
        f"{line} -- noqa",
        f"{line} -- NOQA: ss001",
        f"{line} -- noqa: SS001, SS003",
        f"{line} -- noqa: SS001 some words",
        f"{line} -- noqa: ,",
        f"{line} -- noqa\nSELECT GETDATE();",
    ) == [set(), {"SS003"}, set(), {"SS001", "SS003"}, set(), {"SS001"}]


def test_lookalikes(spark):
    assert codes(
        spark,
        "INSERT INTO t VALUES ('SALES-N', 'x');",
        "INSERT INTO t VALUES (N'x'), ('SALES-N', 'y');",
        "CREATE TABLE t (c TIMESTAMP_NTZ);",
        "BEGIN TRANSACTION;",
        "SELECT MAX(JournalID) AS last_id FROM j;",
        "v_id := (SELECT MAX(j.JournalID) FROM j);",
    ) == [set(), {"SS004"}, set(), set(), set(), {"SS107"}]


def test_tally_and_order(spark):
    found = scan(spark, "SELECT LEN(x);\nSELECT GETDATE();", "SELECT GETDATE();")
    row = corpus.sql_corpus_tally(found).first()
    assert (row.error, row.warning, row.files) == (2, 1, 2)
    assert row.summary == "2 error, 1 warning across 2 file(s)."
    order = [(f.severity, f.path, f.line) for f in corpus.sorted_findings(found).collect()]
    assert order == [("error", "f0.sql", 2), ("error", "f1.sql", 1), ("warning", "f0.sql", 1)]
    assert corpus.sql_corpus_tally(scan(spark, "SELECT 1")).first().summary == "No dialect issues found."


def test_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.sql").write_bytes(b"\xef\xbb\xbfSELECT LEN(x);\n\xff /* \n LEN( \n*/\nGETDATE()")
    (tmp_path / "b.SQL").write_text("PRINT 'x'")
    (tmp_path / "c.txt").write_text("PRINT 'x'")
    found = corpus.sql_corpus_findings(files.read_sql_files(spark, str(tmp_path))).collect()
    assert {(f.path.rsplit("/", 1)[1], f.line, f.code, f.column) for f in found} == {
        ("a.sql", 1, "SS104", 8), ("a.sql", 5, "SS001", 1), ("b.SQL", 1, "SS018", 1)}


def test_letters_that_fold_to_ascii_are_all_known(spark):
    """A rule's word is searched for in upper case; no other letter may stand for one of it."""
    points = spark.range(128, 0x110000).where("id NOT BETWEEN 55296 AND 57343")
    both = points.selectExpr("id", "decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32') AS c")
    found = both.where(r"c RLIKE '(?iU)^(?:[A-Z]|[a-z])$'").collect()
    assert {r.c for r in found} == set(corpus.FOLDED)
    folds = dict(zip(corpus.FOLDED, "IISK"))
    for r in found:
        assert spark.range(1).selectExpr(f"'{folds[r.c]}' RLIKE '(?iU)^{r.c}$' AS same").first().same


def _chunked(spark, texts, blocks):
    """Files cut behind every line feed; ``blocks`` chunks to a block."""
    rows = []
    for path, text in texts.items():
        parts = [p for p in re.split(r"(?<=\n)", text) if p] or [""]
        rows += [(path, k // blocks, k, p) for k, p in enumerate(parts)]
    return spark.createDataFrame(rows, "path string, block long, chunk long, text string")


@pytest.mark.parametrize("blocks", [1, 3, 1000])
def test_chunks_give_what_whole_files_give(spark, blocks):
    """Random texts of delimiters, words and all line ends, cut behind every line feed."""
    rng = random.Random(blocks)
    words = ["/*", "*/", "--", "/", "*", "-", "/*/", "\n", "\n", "\r", "\r\n", "\u2028", "LEN(", "LEN(", "GETDATE()", "\nLEN(", " x ", "'", "-- noqa", "\U0001f600"]
    texts = {f"f{k}.sql": "".join(rng.choices(words, k=rng.randint(0, 40))) for k in range(400)}
    texts |= {"bom.sql": "\ufeff/*\n\ufeff LEN( */ LEN(\nLEN(", "open.sql": "/*" + "\nLEN(" * 20, "none.sql": ""}
    whole = spark.createDataFrame(list(texts.items()), "path string, text string")
    expected = sorted(corpus.sql_corpus_findings(whole).collect())
    assert len(expected) > 300
    assert sorted(corpus.sql_chunk_findings(_chunked(spark, texts, blocks)).collect()) == expected


def test_large_files_are_read_in_chunks(spark, tmp_path):
    """A file over several blocks, with a comment open across them, and small files beside it."""
    body = "".join(f"SELECT LEN(c{k}) /* {'open' if k % 7 == 3 else '*/'}\nGETDATE()\n" for k in range(20_000))
    (tmp_path / "large.sql").write_text(body)
    (tmp_path / "small.sql").write_text("SELECT LEN(x);\r\nPRINT 'x'")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        chunks = files.read_sql_chunks(spark, str(tmp_path), most=10_000, lines=500)
        counts = {r.path.rsplit("/", 1)[1]: (r.blocks, r.chunks) for r in chunks.groupBy("path").agg(
            F.count_distinct("block").alias("blocks"), F.count(F.lit(1)).alias("chunks")).collect()}
        assert counts["small.sql"] == (1, 1) and counts["large.sql"][0] > 3 and counts["large.sql"][1] >= 80
        found = sorted(tuple(r)[1:] for r in corpus.sql_chunk_findings(chunks, "info").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = corpus.sql_corpus_findings(files.read_sql_files(spark, str(tmp_path)), "info").collect()
    assert found == sorted(tuple(r)[1:] for r in whole) and len(found) > 5000
