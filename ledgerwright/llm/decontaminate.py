"""Benchmark decontamination: every training passage queries a BM25 index of test items.

A word is a run of bytes other than ASCII white space, control and punctuation, with
A-Z lower-cased. Items longer than ``PART`` words are indexed in parts, so that any
part that occurs in a document lies whole in one of its passages of ``2 * PART`` words,
which begin every ``PART`` words.

The score of a passage for a part is BM25 with the passage as the query, divided by the
part's own score, so that 1 means that all of its words occur. The index is inverted:
for each term the parts that hold it with their weights, in order of length. Parts are
in blocks of ``BLOCK`` neighbours, and each term has its greatest weight within each
block. As in block-max WAND, a passage first adds up its terms' greatest weights per
block and opens only the blocks whose bound reaches the threshold; these are scored
exactly and everything at or above the threshold is verified. No result is cut.

Verification compares runs of five words of the item's question and answer with the
document around the passage. An item without an ``answer`` column has its last
sentence as its answer, and all of it as both if it is one sentence. A document is
reported for an item if both overlaps reach ``OVERLAP``.

The index is broadcast. Its size is bounded: items are dealt by hash into shards of
about ``SHARD_WORDS`` words, each shard is one pass over the documents, and document
frequencies are counted over all items. Null and empty texts, on either side, match
nothing. Repeated rows give equal result rows, reported once. Null ids are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.llm import words
from ledgerwright.llm.shared import Workspace, arrow_map, slices

PART = 64
BLOCK = 16
THRESHOLD = 0.7
OVERLAP = 0.8
RUN = 5
K1, B = 1.2, 0.75
SHARD_WORDS = 1_000_000
_BYTES = 2 << 20
_SENTENCE = re.compile(r"[.!?]\s+")
_TABLE_BITS = 20
_SCHEMA = (
    "doc_id long, item_id long, start_word long, score double, question_overlap double, answer_overlap double"
)


def _terms(text: str) -> np.ndarray:
    return words.hashed(pa.array([text], pa.string()), lower=True, blanks=words.PUNCTUATION)[0]


def split_item(text: str, answer: str | None = None) -> tuple[str, str]:
    """Question and answer of an item."""
    if answer is not None:
        return text, answer
    ends = [m.end() for m in _SENTENCE.finditer(text.strip())]
    text = text.strip()
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, text)


def _runs(tokens: np.ndarray) -> np.ndarray:
    return np.unique(words.shingles(tokens, RUN))


@dataclass
class Index:
    """Postings of a shard of items; see the module."""

    ids: list
    checks: list  # of each item: runs and number of words of the question, the same of the answer, words in all
    terms: np.ndarray  # sorted hashes
    cells: np.ndarray  # of each posting: term and block as one number, in order
    part: np.ndarray
    weight: np.ndarray
    owner: np.ndarray  # item of each part
    bounds: np.ndarray  # greatest weight of each term (rows) in each block (columns)
    table: np.ndarray  # low bits of the terms, a quick first test


def build_index(items: list[tuple], frequency: dict[int, int], n_items: int, mean: float) -> Index:
    """``items`` are (id, question, answer); ``frequency`` counts items by term over all shards."""
    ids, checks, parts = [], [], []
    for item, question, answer in items:
        q, a = _terms(question), _terms(answer)
        whole = q if question == answer else np.concatenate([q, a])
        if not len(whole):
            continue
        owner = len(ids)
        ids.append(item)
        checks.append(((_runs(q), len(q)), (_runs(a), len(a)), len(whole)))
        parts += [(owner, whole[k : k + PART]) for k in range(0, len(whole), PART)]
    parts.sort(key=lambda p: (len(p[1]), p[0]))
    rows = []
    for k, (_, tokens) in enumerate(parts):
        term, tf = np.unique(tokens, return_counts=True)
        df = np.array([frequency.get(int(t), 1) for t in term.view(np.int64)], float)
        idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
        w = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(tokens) / mean))
        rows.append((term, np.full(len(term), k), w / w.sum()))
    if not rows:
        empty = np.empty(0)
        return Index([], [], empty, empty, empty, empty, empty, empty, empty)
    term, part, weight = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.lexsort([part, term])
    terms, starts = np.unique(term[order], return_index=True)
    part, weight = part[order], weight[order]
    row = np.repeat(np.arange(len(terms)), np.diff(np.append(starts, len(part))))
    blocks = (len(parts) + BLOCK - 1) // BLOCK
    bounds = np.zeros((len(terms), blocks), np.float32)
    np.maximum.at(bounds, (row, part // BLOCK), weight.astype(np.float32))
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(terms & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)] = True
    owner = np.array([o for o, _ in parts])
    return Index(ids, checks, terms, row * blocks + part // BLOCK, part, weight, owner, bounds, table)


def _known(index: Index, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and term numbers of the tokens in the index."""
    at = np.flatnonzero(index.table[(tokens & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)])
    term = np.minimum(np.searchsorted(index.terms, tokens[at]), len(index.terms) - 1)
    hit = index.terms[term] == tokens[at]
    return at[hit], term[hit]


def retrieve(index: Index, tokens: np.ndarray, at: np.ndarray, threshold: float) -> Iterator[tuple]:
    """(document, first word of the passage, part, score) for all passages and parts at or above the threshold."""
    position, term = _known(index, tokens)
    if not len(position):
        return
    doc = np.searchsorted(at, position, "right") - 1
    local = position - at[doc]
    n_words = np.diff(at)
    # A word lies in the passages that begin in its own run of PART words and in the run before it.
    passages = np.maximum(1, (n_words - 1) // PART)
    first = np.concatenate([[0], np.cumsum(passages)])
    run = local // PART
    own = first[doc] + np.minimum(run, passages[doc] - 1)
    before = first[doc] + run - 1
    both = (run > 0) & (run <= passages[doc] - 1)
    passage = np.concatenate([own, before[both]])
    vocabulary = len(index.terms)
    pairs = np.unique(passage * vocabulary + np.concatenate([term, term[both]]))
    passage, term = pairs // vocabulary, pairs % vocabulary
    found, begins = np.unique(passage, return_index=True)
    ends = np.append(begins[1:], len(passage))
    most = index.bounds.max(axis=1)
    hopeful = np.flatnonzero(np.add.reduceat(most[term], begins) >= threshold - 1e-4)
    for step in range(0, len(hopeful), 1024):
        some = hopeful[step : step + 1024]
        length = ends[some] - begins[some]
        rows = np.repeat(begins[some], length) + _counting(length)
        offsets = np.concatenate([[0], np.cumsum(length)[:-1]])
        bound = np.add.reduceat(index.bounds[term[rows]], offsets, axis=0)
        opened = np.stack(np.nonzero(bound >= threshold - 1e-4))
        for at_once in range(0, opened.shape[1], 4096):
            i, b = opened[:, at_once : at_once + 4096]
            k = some[i]
            score = _scores(index, term, begins[k], ends[k] - begins[k], b)
            for pair, j in zip(*np.nonzero(score >= threshold), strict=True):
                d = int(np.searchsorted(first, found[k[pair]], "right") - 1)
                start = int(found[k[pair]] - first[d]) * PART
                yield d, start, int(b[pair] * BLOCK + j), float(score[pair, j])


def _scores(index: Index, term: np.ndarray, begins: np.ndarray, lengths: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Exact scores of passages (rows), given by their terms, for the parts of a block each (columns)."""
    pair = np.repeat(np.arange(len(begins)), lengths)
    cell = term[np.repeat(begins, lengths) + _counting(lengths)] * index.bounds.shape[1] + blocks[pair]
    low = np.searchsorted(index.cells, cell, "left")
    count = np.searchsorted(index.cells, cell, "right") - low
    held = np.flatnonzero(count)
    posting = np.repeat(low[held], count[held]) + _counting(count[held])
    place = np.repeat(pair[held], count[held]) * BLOCK + index.part[posting] % BLOCK
    return np.bincount(place, index.weight[posting], len(begins) * BLOCK).reshape(-1, BLOCK)


def _counting(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length, one after the other."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - lengths, lengths)


def _present(runs: np.ndarray, n_words: int, text: np.ndarray) -> float:
    """Share of the runs in the text; a part shorter than a run is looked up at its own length."""
    if not n_words:
        return 1.0
    return float(np.isin(runs, words.shingles(text, min(RUN, n_words))).mean())


def _matches(index: Index, texts: pa.Array, threshold: float, overlap: float) -> dict[tuple, tuple]:
    """By row and item, the best verified passage: score, minus its first word, both overlaps."""
    best: dict[tuple, tuple] = {}
    if not index.ids:
        return best
    tokens, at = words.hashed(texts, lower=True, blanks=words.PUNCTUATION)
    for d, start, part, score in retrieve(index, tokens, at, threshold):
        item = int(index.owner[part])
        question, answer, n = index.checks[item]
        low = max(int(at[d]), int(at[d]) + start - n)
        around = tokens[low : min(int(at[d + 1]), int(at[d]) + start + 2 * PART + n)]
        both = [_present(*side, around) for side in (question, answer)]
        if min(both) >= overlap:
            row = (score, -start, *both)
            best[d, item] = max(best.get((d, item), row), row)
    return best


def _indexes(items: DataFrame, answer: str | None, space: Workspace) -> Iterator[Index]:
    """An index for each shard of the items."""
    chosen = items.where("text IS NOT NULL").select(
        F.col("item_id").cast("long"), "text", (F.col(answer) if answer else F.lit(None).cast("string")).alias("answer")
    )

    def parted(text, reply):
        question, reply = split_item(text, reply)
        return (text if question == reply else f"{question}\n{reply}"), question, reply

    def of(batches):
        for batch in batches:
            rows = [parted(t, a) for t, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            found = [_terms(whole) for whole, _, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([q for _, q, _ in rows], pa.string()),
                    pa.array([a for _, _, a in rows], pa.string()),
                    pa.array([np.unique(t).view(np.int64) for t in found], pa.list_(pa.int64())),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                ["item_id", "question", "answer", "terms", "n"],
            )

    schema = "item_id long, question string, answer string, terms array<long>, n long"
    made = space.store(arrow_map(chosen, of, schema), "items").where("n > 0")
    total = made.agg(
        F.count(F.lit(1)).alias("items"), F.sum("n").alias("words"), F.sum(F.ceil(F.col("n") / PART)).alias("parts")
    ).first()
    if not total["items"]:
        return
    shards = int(-(-total["words"] // SHARD_WORDS))
    made = made.withColumn("shard", F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(shards)))
    terms = made.select("shard", F.explode("terms").alias("term"))
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    named = space.store(terms.distinct().join(counted, "term"), "terms")
    for shard in range(shards):
        frequency = {r.term: r.df for r in named.where(F.col("shard") == shard).collect()}
        rows = made.where(F.col("shard") == shard).select("item_id", "question", "answer").collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.question, r.answer))
        yield build_index([tuple(r) for r in rows], frequency, total["items"], total["words"] / total["parts"])


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    answer: str | None = None,
    space: Workspace | None = None,
) -> DataFrame:
    """A row for each document (doc_id, text) and item (item_id, text) that it holds, with its best passage."""
    spark = docs.sparkSession
    space = space or Workspace(spark, "decontaminate")
    chosen = docs.select(F.col("doc_id").cast("long"), "text")
    found = [spark.createDataFrame([], _SCHEMA)]
    for index in _indexes(items, answer, space):
        shared = spark.sparkContext.broadcast(index)

        def of(batches, shared=shared):
            for whole in batches:
                for batch in slices(whole, "text", _BYTES):
                    ids = batch.column(0).to_pylist()
                    best = _matches(shared.value, batch.column(1), threshold, overlap)
                    rows = [(ids[d], shared.value.ids[i], -s[1], s[0], s[2], s[3]) for (d, i), s in best.items()]
                    columns = zip(*rows, strict=True) if rows else [()] * len(_KINDS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(columns, _KINDS.values(), strict=True)], list(_KINDS)
                    )

        found.append(arrow_map(chosen, of, _SCHEMA))
    best = F.max(F.struct("score", (-F.col("start_word")).alias("minus"), "question_overlap", "answer_overlap"))
    rows = reduce(DataFrame.unionAll, found).groupBy("doc_id", "item_id").agg(best.alias("best"))
    return rows.select(
        "doc_id",
        "item_id",
        (-F.col("best.minus")).alias("start_word"),
        F.col("best.score").alias("score"),
        F.col("best.question_overlap").alias("question_overlap"),
        F.col("best.answer_overlap").alias("answer_overlap"),
    )


_KINDS = {
    "doc_id": pa.int64(),
    "item_id": pa.int64(),
    "start_word": pa.int64(),
    "score": pa.float64(),
    "question_overlap": pa.float64(),
    "answer_overlap": pa.float64(),
}


def clean(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    answer: str | None = None,
    space: Workspace | None = None,
) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns stay as they are."""
    spark = docs.sparkSession
    space = space or Workspace(spark, "decontaminate")
    at = docs.columns.index("text")
    for index in _indexes(items, answer, space):
        shared = spark.sparkContext.broadcast(index)

        def of(batches, shared=shared):
            for whole in batches:
                for batch in slices(whole, "text", _BYTES):
                    stay = np.ones(batch.num_rows, bool)
                    stay[[d for d, _ in _matches(shared.value, batch.column(at), threshold, overlap)]] = False
                    yield batch.filter(pa.array(stay))

        docs = arrow_map(docs, of, docs.schema)
    return docs
