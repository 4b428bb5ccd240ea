"""Removal of word sequences that a document with a smaller id has too, by sharded FM-indexes.

A window is ``WINDOW`` consecutive words. Its key is the least hash of the runs of
``GRAM`` words in it; neighbouring windows mostly share it, and equal windows always do.

1. Each document is cut into segments of windows with one key. Per key Spark keeps the
   least and greatest document and a count; only keys of two documents or more go on,
   so text that occurs once is not indexed.
2. The segments of those keys are taken out of the documents and dealt to shards by
   key. A key with more than ``HOT`` segments is dealt window by window, by the window's
   own hash, so no shard depends on how common a key is. Equal segments are reduced
   before the shuffle to one with their least document.
3. A shard builds an FM-index (fm_index.py) of its distinct segments, and streams them
   through it: matching statistics give the interval of every window, and the interval
   the least document that has the window.
4. Every occurrence of a segment compares its document with these. Covered words go.

Words are compared by 64-bit hash (words.py). Null and empty texts have no words, and
texts shorter than a window lose none. A document with a null id is not compared: it is
neither smaller nor greater. Rows that repeat an id are one document several times;
equal rows get equal results. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.llm import words
from ledgerwright.llm.fm_index import FMIndex, matching
from ledgerwright.llm.shared import Workspace, arrow_map, slices

WINDOW = 13
GRAM = 4
HOT = 20_000
#: Windows of a segment at most, and segments of a shard on average.
LONGEST = 64
SHARD = 60_000
_BYTES = 2 << 20
#: A segment in a long: first word, windows, 16 bits that tell texts of one id apart.
_WINDOWS_AT, _TAG_AT = 32, 40


def _windows_least(tokens: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The least run hash of every window of consecutive words."""
    least = words.shingles(tokens, gram)
    need, have = window - gram + 1, 1
    while have < need:
        step = min(have, need - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def _segments(tokens: np.ndarray, at: np.ndarray, window: int, gram: int):
    """Document, first word within it, windows and key of all segments."""
    if len(tokens) < window:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    key = _windows_least(tokens, window, gram)
    place = np.arange(len(key))
    doc = np.searchsorted(at, place, "right") - 1
    inside = place + window <= at[doc + 1]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    run_at = np.flatnonzero(first)
    since = place - np.repeat(run_at, np.diff(np.append(run_at, len(key))))
    first |= since % LONGEST == 0
    begins = np.flatnonzero(first & inside)
    ends = np.append(np.flatnonzero(first), len(key))
    ends = ends[np.searchsorted(ends, begins, "right")]
    d = doc[begins]
    count = np.minimum(ends, at[d + 1] - window + 1) - begins
    return d, begins - at[d], count, key[begins]


def _packed(start: np.ndarray, windows: np.ndarray, tag: np.ndarray) -> np.ndarray:
    return start | windows << _WINDOWS_AT | tag << _TAG_AT


def _tag(text: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << 16))


def _all_segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", _BYTES):
                d, start, windows, key = _segments(*words.hashed(batch.column(1)), window, gram)
                ids, tag = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(ids[d]),
                        pa.array(_packed(start, windows, tag[d])),
                    ],
                    ["key", "doc", "at"],
                )

    return arrow_map(docs, of, "key long, doc long, at long")


def _cut(shards: int, window: int):
    """Segments as rows: where they are, and once for each slice of documents their words and least document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", _BYTES):
                tokens, begin = words.hashed(batch.column(1))
                ids = batch.column(0).to_numpy()
                lists = batch.column(2)
                flat = lists.flatten()
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                at, key, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                start, count = at & ((1 << _WINDOWS_AT) - 1), at >> _WINDOWS_AT & 0xFF
                tag = at >> _TAG_AT
                # Windows of hot keys are segments of their own.
                times = np.where(hot, count, 1)
                again = np.repeat(np.arange(len(row)), times)
                nth = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                row, hot, key, tag = row[again], hot[again], key[again], tag[again]
                start, count = start[again] + nth, np.where(hot, 1, count[again])
                seen: dict[bytes, int] = {}
                number, least, content = np.empty(len(row), np.int64), [], []
                for i, (s, n) in enumerate(zip(begin[row] + start, count + window - 1, strict=True)):
                    value = tokens[s : s + n].tobytes()
                    k = seen.setdefault(value, len(seen))
                    number[i] = k
                    if k == len(content):
                        content.append(value)
                        least.append(ids[row[i]])
                    elif ids[row[i]] < least[k]:
                        least[k] = ids[row[i]]
                names = [hashlib.blake2b(v, digest_size=16).digest() for v in content]
                first = np.full(len(content), -1, np.int64)
                first[number[::-1]] = np.arange(len(number))[::-1]
                head = first[number] == np.arange(len(number))
                own = np.array([int.from_bytes(v[:8], "little", signed=True) for v in names], np.int64)
                shard = (np.where(hot, own[number] if len(own) else 0, key) % shards).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row]),
                        pa.array(_packed(start, count, tag)),
                        pa.array([names[k] for k in number], pa.binary()),
                        pa.array(shard),
                        pa.array([content[k] if h else None for k, h in zip(number, head, strict=True)], pa.binary()),
                        pa.array([least[k] for k in number], pa.int64()),
                    ],
                    ["doc", "at", "segment", "shard", "words", "least"],
                )

    return of


_CUT = "doc long, at long, segment binary, shard int, words binary, least long"


def _least_documents(window: int):
    """For the segments of one shard after the other: the least document of each of their windows."""

    def solve(names: list[bytes], contents: list[bytes], least: np.ndarray) -> list[bytes]:
        lengths = np.array([len(c) // 8 for c in contents])
        _, numbers = np.unique(np.frombuffer(b"".join(contents), np.uint64), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        # A 0 after each segment.
        owner = np.repeat(np.arange(len(lengths)), lengths)
        text = np.zeros(len(numbers) + len(lengths), np.int64)
        text[np.arange(len(numbers)) + owner] = numbers + 1
        index = FMIndex(text, window)
        which = np.repeat(np.arange(len(lengths)), lengths + 1)
        begins = np.unique(index.group[0])
        smallest = np.minimum.reduceat(least[which[index.order]], begins)
        smallest = np.repeat(smallest, np.diff(np.append(begins, len(text))))
        out = np.full(len(numbers), np.iinfo(np.int64).max)
        for pattern, offset, low, _ in matching(index, numbers + 1, starts, lengths):
            out[starts[pattern] + offset] = smallest[low]
        return [out[s : s + n - window + 1].tobytes() for s, n in zip(starts, lengths, strict=True)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = None, {}

        def done():
            if found:
                names = list(found)
                contents, least = zip(*found.values(), strict=True)
                answers = solve(names, list(contents), np.array(least, np.int64))
                for k in range(0, len(names), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[k : k + 10_000], pa.binary()), pa.array(answers[k : k + 10_000], pa.binary())],
                        ["segment", "least"],
                    )

        for batch in batches:
            for s, name, content, doc in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if s != shard:
                    yield from done()
                    shard, found = s, {}
                old = found.get(name)
                if old is None or doc < old[1]:
                    found[name] = (content, doc)
        yield from done()

    return of


def _covered(window: int):
    """Segment occurrences as ranges of words that a smaller document has too."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = batch.column(2)
            sizes = np.array([len(v) // 8 for v in least.to_pylist()], np.int64)
            flat = np.frombuffer(b"".join(least.to_pylist()), np.int64)
            doc, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            dup = flat < doc[owner]
            inner = owner[1:] == owner[:-1]
            first = dup.copy()
            first[1:] &= ~(dup[:-1] & inner)
            last = dup.copy()
            last[:-1] &= ~(dup[1:] & inner)
            row = owner[first]
            start = (at[row] & ((1 << _WINDOWS_AT) - 1)) - (np.cumsum(sizes) - sizes)[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[row]),
                    pa.array(at[row] >> _TAG_AT),
                    pa.array(start + np.flatnonzero(first)),
                    pa.array(start + np.flatnonzero(last) + window),
                ],
                ["doc", "tag", "begin", "end"],
            )

    return of


def removed_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, space: Workspace | None = None) -> DataFrame:
    """(doc, gone: array of (tag, begin, end)) of every document that loses words; ranges may overlap."""
    space = space or Workspace(docs.sparkSession, "substring-dedup")
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long"), "text", _tag(F.col("text")).alias("tag")
    )
    segments = _all_segments(texts, window, gram)
    shared = (
        segments.groupBy("key")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high")
        .select("key", (F.col("n") > HOT).alias("hot"), "n")
    )
    shared = space.store(shared, "keys")
    total = shared.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    per_doc = (
        segments.join(shared.select("key", "hot"), "key")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("at", "key", "hot")).alias("segments"))
    )
    per_doc = space.store(per_doc, "by-document")
    held = (
        texts.join(per_doc.withColumnRenamed("doc", "doc_id"), "doc_id")
        .select("doc_id", "text", F.filter("segments", lambda s: F.shiftright(s["at"], _TAG_AT) == F.col("tag")).alias("s"))
    )
    found = space.store(arrow_map(held, _cut(int(shards), window), _CUT), "segments")
    dealt = (
        found.where("words IS NOT NULL").select("shard", "segment", "words", "least")
        .repartition(int(shards), "shard").sortWithinPartitions("shard")
    )
    least = space.store(arrow_map(dealt, _least_documents(window), "segment binary, least binary"), "least")
    places = found.select("doc", "at", "segment").join(least, "segment").select("doc", "at", "least")
    ranges = arrow_map(places, _covered(window), "doc long, tag long, begin long, end long")
    gone = ranges.groupBy("doc").agg(F.collect_list(F.struct("tag", "begin", "end")).alias("gone"))
    return space.store(gone, "ranges")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, space: Workspace | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and the text of the words left, joined by single spaces."""
    gone = removed_ranges(docs, window, gram, space)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 2 * _BYTES):
                counts, removed, texts = [], [], []
                for text, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    found = text.encode().split() if text else []  # bytes split at the same six characters
                    counts.append(len(found))
                    if lost:
                        stay = bytearray(b"\1") * len(found)
                        for r in lost:
                            stay[r["begin"] : r["end"]] = bytes(r["end"] - r["begin"])
                        found = list(compress(found, stay))
                    removed.append(counts[-1] - len(found))
                    texts.append(b" ".join(found).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "n_removed", "text"],
                )

    joined = docs.select(F.col("doc_id").cast("long"), "text").join(
        gone.withColumnRenamed("doc", "doc_id"), "doc_id", "left"
    )
    own = joined.select("doc_id", "text", F.filter("gone", lambda r: r["tag"] == _tag(F.col("text"))).alias("gone"))
    return arrow_map(own, of, "doc_id long, n_words long, n_removed long, text string")
