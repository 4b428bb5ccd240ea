"""The operators as named queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwright.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    fingerprint,
    html_text,
    language,
    line_dedup,
    near_dedup,
    packing,
    spelling,
    substring_dedup,
    toxicity,
    url_filter,
)
from ledgerwright.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
#: The same rows in SQL for DuckDB, where SQL can express them.
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op3_minhash_near_dedup(spark, d):
    return near_dedup.near_duplicates(table(spark, d, "documents"), size=3, percent=85, lower=True)


@query
def op5_line_dedup(spark, d):
    rows = line_dedup.dedup_lines(table(spark, d, "documents"))
    return rows.select(
        "doc_id",
        F.col("__lines").cast("long").alias("n_lines"),
        F.col("__removed").cast("long").alias("n_removed"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@query
def op9_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"))


@query
def op2_benchmark_decontamination(spark, d):
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op6_language_id(spark, d):
    return language.predict(table(spark, d, "documents"))


@query
def op4_substring_dedup(spark, d):
    rows = substring_dedup.dedup_substrings(table(spark, d, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_toxicity(spark, d):
    return toxicity.predict(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op8_html_extraction(spark, d):
    return html_text.extract(table(spark, d, "pages"))


@query
def op10_iblt_fingerprint(spark, d):
    return fingerprint.fingerprints(table(spark, d, "documents"))


@query
def op1_url_filter(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return url_filter.judge(url_filter.captures_of(pages), url_filter.entries_of(pages))


ORACLES["op1_url_filter"] = url_filter.ORACLE


@query
def op13_byte_bpe(spark, d):
    rows = byte_bpe.decode(byte_bpe.encode(table(spark, d, "documents")))
    return rows.selectExpr(
        "doc_id",
        "CAST(length(ids) / 4 AS BIGINT) AS n_tokens",
        "sha2(ids, 256) AS ids_sha256",
        "sha2(data, 256) AS decoded_sha256",
    )


@query
def op12_source_divergence(spark, d):
    return divergence.audit(table(spark, d, "documents"))


ORACLES["op12_source_divergence"] = divergence.ORACLE


@query
def op11_spelling_variants(spark, d):
    return spelling.variants(table(spark, d, "documents"))
