"""Packing documents into sequences of a fixed length, by dominance and best fit.

Documents become token ids; only those longer than a sequence are cut. What has to be
packed is then a count for each length from 1 to ``CAPACITY``, which does not grow
with the corpus, so the packing itself is solved once on the driver over these counts:

1. Reduction after Martello and Toth: beside the longest remaining piece, the set of at
   most two others that dominates all sets that fit is fixed with it. Dominant are
   nothing where nothing fits; one piece that fills the rest, or that is the longest
   where no two fit, or as long as any two that do; and two pieces where no three fit
   and any other two are no longer, one by one. This never costs a sequence. Equal
   sequences are fixed at once, so the work does not depend on the counts.
2. Where nothing dominates, the longest piece opens a sequence that is filled best-fit:
   the longest piece that fits, again and again. Then reduction is tried anew.

The result is a list of patterns with a repetition count. Spark numbers the pieces of
each length and looks the place of each number up in the patterns.

Null and empty texts are the end token only. Null ids are kept. Repeated rows are
packed once each: every row is a document of its own. Further columns do not matter.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.llm.shared import Workspace, arrow_map, slices

CAPACITY = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Chunks that a task remembers with their ids.
_MEMORY = 500_000
_SHORT = 48
#: Text whose distinct chunks are looked up once.
_BYTES = 16 << 20
#: Composed letters that the vocabulary's normalization only lower-cases, and its rule for pieces.
_LETTERS = "À-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[!-~¡¿{_LETTERS}]+")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: A character for each byte: printable ones stand for themselves, the others follow 255 in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARACTERS = [
    chr(b) if b in _PRINTABLE else chr(256 + sum(c not in _PRINTABLE for c in range(b))) for b in range(256)
]


def _little(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Pieces(dict):
    """Ids of lower-case pieces that the vocabulary's rules never cut further, as little-endian bytes."""

    def __init__(self, model):
        self._model = model

    def __missing__(self, piece: str) -> bytes:
        # Pieces hold no white space, so the bytes of ASCII stand for themselves.
        mapped = piece if piece.isascii() else "".join(map(_BYTE_CHARACTERS.__getitem__, piece.encode()))
        out = _little([t.id for t in self._model.tokenize(mapped)])
        if len(self) >= _MEMORY:
            self.clear()
        self[piece] = out
        return out


class Chunks(dict):
    """Token ids of chunks of text between white space, as little-endian bytes.

    The vocabulary's rules never join characters across white space, so the ids of a
    text are those of its chunks in order. The chunks seen are remembered. In
    chunks of printable ASCII and Latin-1 letters the rules are applied here, which
    leaves only new pieces to the tokenizer; all others go through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._pieces = _Pieces(self._tokenizer.model)

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            text = text.lower()
            out = self._pieces[text] if text.isalpha() else b"".join(map(self._pieces.__getitem__, _SPLIT.findall(text)))
        else:
            out = _little(self._tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self) >= _MEMORY:
            self.clear()
        if len(chunk) <= _SHORT:
            self[chunk] = out
        return out

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split())) if text else b""

    def forget(self) -> None:
        """Drop the chunks and pieces seen."""
        self.clear()
        self._pieces.clear()

    def all_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in order, and the n + 1 positions where each text's begin. Null is empty."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = words.flatten().dictionary_encode()
        found = [self[chunk] for chunk in coded.dictionary.cast(pa.large_binary()).to_pylist()]
        data = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, which = np.cumsum(lengths) - lengths, coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths[which])])
        ids = data[np.repeat(starts[which] - ends[:-1], lengths[which]) + np.arange(ends[-1])]
        first = words.offsets.to_numpy()
        return ids, ends[first - first[0]]


@lru_cache(1)
def _chunks(path: str) -> Chunks:
    """The tokenizer is kept from task to task of a worker, what it has seen is not: other stages use the worker, too."""
    return Chunks(path)


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece, with the task that made it and its number among that task's pieces of its length."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _chunks(path or vocabulary())
        end = _little([END])
        task, made = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for batch in slices(whole, "text", _BYTES):
                out = []
                tokens, bounds = chunks.all_ids(batch.column(1))
                for doc, low, high in zip(batch.column(0).to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    ids = tokens[low:high].tobytes() + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        n = len(part) // 4
                        out.append((doc, k, at // 4, n, zlib.crc32(part), task, made[n]))
                        made[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _NAMES
                )
        chunks.forget()

    return arrow_map(
        docs.select(F.col("doc_id").cast("long"), "text"),
        of,
        "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long",
    )


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


class _Left:
    """Counts of the lengths still to be packed; a bit is set for each length that is left."""

    def __init__(self, counts):
        self.counts = [int(n) for n in counts]
        self.bits = sum(1 << n for n, k in enumerate(self.counts) if k and n)

    def longest(self, most: int) -> int:
        """The longest remaining length up to ``most``; 0 if there is none."""
        return max(0, (self.bits & ((1 << (most + 1)) - 1)).bit_length() - 1) if most > 0 else 0

    def least(self) -> int:
        return (self.bits & -self.bits).bit_length() - 1 if self.bits else 0

    def add(self, length: int, n: int) -> None:
        self.counts[length] += n
        if self.counts[length]:
            self.bits |= 1 << length
        else:
            self.bits &= ~(1 << length)

    def partner(self, a: int, most: int) -> int:
        """The longest piece up to ``most`` beside one piece ``a`` that is spoken for."""
        b = self.longest(most)
        return self.longest(b - 1) if b == a and self.counts[a] < 2 else b


def _dominant(left: _Left, room: int) -> list[int] | None:
    """The set that dominates all others in ``room``; None where none is sure to."""
    first = left.longest(room)
    if not first:
        return []
    least = left.least()
    if first == room or least + left.partner(least, room - least) > room or not left.partner(least, room - least):
        return [first]
    if 3 * least <= room:
        return None
    # At most two pieces fit. One dominates all pairs if it is as long as their sum; a pair
    # dominates if no other pair has a longer shorter piece.
    half = left.longest(room // 2)
    while half and left.counts[half] < 2 and not half < left.longest(room - half):
        half = left.longest(half - 1)
    second = left.partner(first, room - first)
    best, a = 0, left.longest(room - least)
    while a and a >= half:
        b = left.partner(a, min(a, room - a))
        best = max(best, a + b if b else 0)
        a = left.longest(a - 1)
    if first >= best:
        return [first]
    if second and min(first, second) >= half:
        return [first, second]
    return None


def patterns(counts) -> tuple[list[tuple[int, list[int]]], int]:
    """(repetitions, lengths) of sequences that hold all pieces, and how many of them dominance fixed.

    ``counts[n]`` is the number of pieces of length n; the capacity is its last index.
    """
    capacity, left = len(counts) - 1, _Left(counts)
    out, fixed = [], 0
    while longest := left.longest(capacity):
        left.add(longest, -1)
        content, room = _dominant(left, capacity - longest), capacity - longest
        sure = content is not None
        if not sure:
            content = []
            while n := left.longest(room):
                content.append(n)
                left.add(n, -1)
                room -= n
            for n in content:
                left.add(n, 1)
        left.add(longest, 1)
        lengths = [longest, *content]
        need = {n: lengths.count(n) for n in lengths}
        times = min(left.counts[n] // k for n, k in need.items())
        for n, k in need.items():
            left.add(n, -k * times)
        out.append((times, sorted(lengths, reverse=True)))
        fixed += times * sure
    return out, fixed


#: Lengths are below 2^13, numbers within a length below 2^50.
_SHIFT = 50


def _runs(found: list[tuple[int, list[int]]]) -> np.ndarray:
    """Sorted rows (length and first number as one key, pieces a sequence, first sequence, offset)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, lengths in found:
        offset = 0
        for n in dict.fromkeys(lengths):
            k = lengths.count(n)
            rows.append((n << _SHIFT | used.get(n, 0), k, sequence, offset))
            used[n] = used.get(n, 0) + k * times
            offset += k * n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, space: Workspace | None = None
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    space = space or Workspace(spark, "packing")
    made = space.store(pieces(docs, path, capacity), "pieces")
    sizes = space.store(made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "sizes")
    counts = [0] * (capacity + 1)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length at most
        counts[row.length] = row.n
    runs = spark.sparkContext.broadcast(_runs(patterns(counts)[0]))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = space.store(
        sizes.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "first"
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        for batch in batches:
            length = batch.column(3).to_numpy()
            number = batch.column(5).to_numpy()
            row = table[np.searchsorted(table[:, 0], length << _SHIFT | number, "right") - 1]
            index = number - (row[:, 0] & ((1 << _SHIFT) - 1))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(row[:, 2] + index // row[:, 1]),
                    pa.array(row[:, 3] + index % row[:, 1] * length),
                ],
                [*_NAMES[:5], "sequence_id", "offset"],
            )

    numbered = made.join(first, ["length", "task"]).select(
        *_NAMES[:5], (F.col("first") + F.col("number")).alias("number")
    )
    return arrow_map(
        numbered,
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
