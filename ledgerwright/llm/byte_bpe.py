"""Byte-level BPE of whole documents by one encoding of every distinct word, and back.

A pattern cuts a text into pre-tokens ("words"), and each is merged by the ranks of a
vocabulary. Most words of a corpus repeat, so each distinct one is encoded once:

1. Explode. Documents form blocks of about ``BLOCK`` bytes. A block keeps the number of
   the word at every position, and lists its distinct words, in order of their hash.
2. Shuffle the distinct words of all blocks. Words of one hash range form a shard of
   about ``SHARD`` distinct words; a block sends its words of a shard as one row. A task
   encodes each distinct word of its shards once and answers every block that asked. A
   word that fills a third of the corpus is still one entry of a block.
3. Join the answers back to their block, and put the ids together by position. Blocks are
   stored bucketed by their number, so only the answers move.

Decoding joins ids with the vocabulary's table of token bytes; that table has as many
rows as the vocabulary, whatever the corpus, so it is sent to the tasks.

The pattern is applied with the character classes that tiktoken itself uses: where the
``regex`` package knows other letters or numbers, a stand-in of tiktoken's class takes
their place while the text is cut. Special tokens are never produced.

Null and empty texts have no ids. Null ids and repeated rows stay rows of their own. A
text is in one block whatever its length. Further columns do not matter.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.llm.shared import Workspace, arrow_map, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text in a block, or one document.
BLOCK = 8 << 20
#: Distinct words of a shard, about.
SHARD = 100_000
#: One hash in so many is kept to estimate the number of distinct words.
_SAMPLED = 256
_BYTES = 4 << 20


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def encoding(path: str, cut: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=cut, mergeable_ranks=ranks(path), special_tokens={})


def _members(name: str) -> set[str]:
    """The characters of a class as tiktoken knows it."""
    import tiktoken

    one = tiktoken.Encoding("bytes", pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    return set(bytes(one.encode_ordinary(every)).decode())


@cache
def splitter(cut: str) -> Callable[[str], list[bytes]]:
    """A function that cuts a text into pre-tokens as tiktoken does."""
    whole = regex.compile(cut)
    ascii_cut = cut.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
    plain = re.compile(ascii_cut.encode()) if r"\p" not in ascii_cut else None
    letters, numbers = _members(r"\p{L}"), _members(r"\p{N}")
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    here = {r"\p{L}": set(regex.findall(r"\p{L}", every)), r"\p{N}": set(regex.findall(r"\p{N}", every))}
    other = (letters ^ here[r"\p{L}"]) | (numbers ^ here[r"\p{N}"])
    stand_in = {ord(c): "a" if c in letters else "1" if c in numbers else "!" for c in other}
    # One range is searched for fast; only a text with a character in it is compared one by one.
    suspect = re.compile(f"[{re.escape(min(other))}-{re.escape(max(other))}]") if other else None

    def split(text: str) -> list[bytes]:
        if plain is not None and text.isascii():
            return plain.findall(text.encode())
        if suspect is not None and suspect.search(text) and not other.isdisjoint(text):
            return [text[m.start() : m.end()].encode() for m in whole.finditer(text.translate(stand_in))]
        return list(map(str.encode, whole.findall(text)))

    return split


def _ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[start : start + length]`` of every pair, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[shift + np.arange(total)]


def _edges(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Block:
    """Documents in a row, as numbers of their words in order of appearance."""

    def __init__(self):
        self.numbers, self.places = _Numbers(), array("I")
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str, split) -> None:
        before = len(self.places)
        self.places.extend(map(self.numbers.__getitem__, split(text)))
        self.ids.append(doc_id)
        self.counts.append(len(self.places) - before)
        self.size += len(text)

    def rows(self, block: int) -> dict[str, list]:
        """The block's positions, and its distinct words in order of their hash with their numbers."""
        words = list(self.numbers)
        hashes = _hashes(words)
        order = np.argsort(hashes, kind="stable")
        ordered = [words[k] for k in order]
        sample = hashes[hashes < np.uint64((1 << 64) // _SAMPLED)].view(np.int64)
        blob = zstandard.ZstdCompressor(level=3).compress(b"".join(ordered))
        return {
            "block": [block],
            "ids": [self.ids],
            "counts": [self.counts],
            "places": [_packed(np.frombuffer(self.places, np.uint32))],
            "order": [_packed(order)],
            "words": [blob],
            "lengths": [_packed(np.fromiter(map(len, ordered), np.int64, len(ordered)))],
            "sample": [sample.tolist()],
        }


_BLOCKS = {
    "block": (pa.int64(), "long"),
    "ids": (pa.list_(pa.int64()), "array<long>"),
    "counts": (pa.list_(pa.int32()), "array<int>"),
    "places": (pa.binary(), "binary"),
    "order": (pa.binary(), "binary"),
    "words": (pa.binary(), "binary"),
    "lengths": (pa.binary(), "binary"),
    "sample": (pa.list_(pa.int64()), "array<long>"),
}


def _explode(cut: str, most: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, block, number = splitter(cut), _Block(), TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text", _BYTES):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    block.add(doc_id, text or "", split)
                    if block.size >= most:
                        yield packed(block, number)
                        block, number = _Block(), number + 1
        if block.ids:
            yield packed(block, number)

    def packed(block: _Block, number: int) -> pa.RecordBatch:
        rows = block.rows(number)
        return pa.RecordBatch.from_arrays([pa.array(rows[c], t) for c, (t, _) in _BLOCKS.items()], list(_BLOCKS))

    return of


def _words_of(data: bytes, lengths: np.ndarray) -> list[bytes]:
    edges = _edges(lengths).tolist()
    return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _to_shards(shards: int):
    """A block's words as one row for each shard."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, lengths in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data, lengths = zstandard.ZstdDecompressor().decompress(data), _unpacked(lengths)
                edges = _edges(lengths)
                shard = (_hashes(_words_of(data, lengths)) >> np.uint64(32)).astype(np.int64) * shards >> 32
                firsts = np.flatnonzero(np.diff(shard, prepend=-1))
                ends = np.append(firsts[1:], len(shard))
                pack = zstandard.ZstdCompressor(level=1).compress
                for low in range(0, len(firsts), 1024):
                    spans = list(zip(firsts[low : low + 1024].tolist(), ends[low : low + 1024].tolist(), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(shard[a]) for a, _ in spans], pa.int64()),
                            pa.array([block] * len(spans), pa.int64()),
                            pa.array([a for a, _ in spans], pa.int64()),
                            pa.array([pack(data[edges[a] : edges[b]]) for a, b in spans], pa.binary()),
                            pa.array([_packed(lengths[a:b]) for a, b in spans], pa.binary()),
                        ],
                        ["shard", "block", "first", "words", "lengths"],
                    )

    return of


def _encode(path: str, cut: str):
    """The ids of every word of a shard's rows; a word is encoded when it is first met."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge, current, known = encoding(path, cut).encode_ordinary, None, {}
        for batch in batches:
            out = [], [], [], []
            for shard, block, first, data, lengths in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if shard != current:
                    current, known = shard, {}
                ids = []
                for word in _words_of(zstandard.ZstdDecompressor().decompress(data), _unpacked(lengths)):
                    found = known.get(word)
                    if found is None:
                        found = known[word] = merge(word.decode())
                    ids.append(found)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((i for found in ids for i in found), np.int64, int(sizes.sum()))
                for column, value in zip(out, (block, first, _packed(flat), _packed(sizes)), strict=True):
                    column.append(value)
            types = pa.int64(), pa.int64(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["block", "first", "tokens", "sizes"]
            )

    return of


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of the documents of each block, from its positions and the answers in order of its words."""
    for batch in batches:
        for r in range(batch.num_rows):
            ids, counts, places, order, answers = (c[r].as_py() for c in batch.columns)
            tokens = [_unpacked(a["tokens"]).astype("<u4") for a in answers or ()]
            sizes = [_unpacked(a["sizes"]) for a in answers or ()]
            yield from _documents(ids, counts, places, order, tokens, sizes)


def _documents(ids, counts, places, order, tokens, sizes) -> Iterator[pa.RecordBatch]:
    places, order = _unpacked(places), _unpacked(order)
    flat = np.concatenate(tokens) if tokens else np.empty(0, "<u4")
    answered = np.concatenate(sizes) if sizes else order
    starts, sizes = np.empty_like(order), np.empty_like(order)
    starts[order], sizes[order] = _edges(answered)[:-1], answered
    edges = _edges(np.array(counts))
    low = 0
    while low < len(ids):
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + (_BYTES >> 3), "right")) - 1)
        here = places[edges[low] : edges[high]]
        out = _ragged(flat, starts[here], sizes[here])
        cuts = _edges(sizes[here])[edges[low : high + 1] - edges[low]]
        texts = [out[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        columns = [pa.array(ids[low:high], pa.int64()), pa.array(texts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])
        low = high


def encode(
    docs: DataFrame, path: str | None = None, cut: str | None = None, block: int = BLOCK, shard: int = SHARD
) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit numbers) of every row of ``docs``."""
    path, cut = path or vocabulary(), cut or pattern()
    space = Workspace(docs.sparkSession, "byte-bpe")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ", ".join(f"{c} {t}" for c, (_, t) in _BLOCKS.items())
    stored = space.store_by(arrow_map(texts, _explode(cut, block), schema), "blocks", "block")
    distinct = stored.select(F.explode("sample").alias("h")).agg(F.count_distinct("h")).first()[0] * _SAMPLED
    shards = max(1, -(-distinct // shard))
    asked = arrow_map(
        stored.select("block", "words", "lengths"),
        _to_shards(shards),
        "shard long, block long, first long, words binary, lengths binary",
    )
    answers = space.store(
        arrow_map(
            asked.repartition("shard").sortWithinPartitions("shard"),
            _encode(path, cut),
            "block long, first long, tokens binary, sizes binary",
        ),
        "answers",
    )
    answers = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("first", "tokens", "sizes"))).alias("answers"))
    rows = stored.select("block", "ids", "counts", "places", "order").join(answers, "block", "left").drop("block")
    return arrow_map(rows, _assemble, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``data``, the bytes of its ids in order."""
    table = ranks(path or vocabulary())
    most = max(table.values(), default=-1) + 1
    tokens = [b""] * most
    for token, rank in table.items():
        tokens[rank] = token
    # As many tokens as the vocabulary has.
    sent = encoded.sparkSession.sparkContext.broadcast(tokens)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.fromiter(map(len, sent.value), np.int64, most)
        flat, starts = np.frombuffer(b"".join(sent.value), np.uint8), _edges(lengths)[:-1]
        for batch in batches:
            for part in slices(batch, "ids", _BYTES):
                data = []
                for ids in part.column(1).to_pylist():
                    ids = np.frombuffer(ids or b"", "<u4").astype(np.int64)
                    data.append(_ragged(flat, starts[ids], lengths[ids]).tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    return arrow_map(encoded.select("doc_id", "ids"), of, "doc_id long, ids binary, data binary")
