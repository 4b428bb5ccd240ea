"""How the sources of a language differ in their use of words, by an exact recount.

1. First pass: the number of documents of a language that hold a term, for every term.
   Those in at least ``LEAST`` documents are kept.
2. The kept terms of a language are dealt by hash into shards of about ``SHARD``. Each
   shard gets a minimal perfect hash: levels of bits in which a term owns the place it
   alone hashes to, the others going on to the next level. A term's slot is the rank of
   its bit. The terms themselves are stored in slot order.
3. Second pass: the shards are sent to the tasks, at most about ``ROUND`` bytes of them at
   a time, so a vocabulary beyond that takes further passes instead of more memory. A term
   finds its slot and counts if the term stored there is the same; counts are dense arrays,
   one for each source and shard. Arrays are added up in two steps, so what a large source
   has in many partitions is never one task's work.
4. Shares, their differences and ranks follow from the arrays. All pairs of sources are
   compared shard by shard in tiles of about ``TILE`` x ``TILE`` sources.

Shares are whole billionths, 1 + floor(10^9 * (count + 5) / (N + 5 * V)), where N is the
group's occurrences of the V kept terms. All arithmetic is on whole numbers.

Null texts, languages and sources are ''. Every row is a document of its own, repeated or
not. A language without kept terms still has its pairs, with value 0; a source alone in its
language has none. Ties go to the first item in order of its bytes. Further columns do not
matter. A very long text is read whole, as one document.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ledgerwright.llm.shared import Workspace, arrow_map, slices
from ledgerwright.llm.words import mix

LEAST = 30
TOP = 50
#: Terms of a shard, about.
SHARD = 4096
#: Bytes of shards that are sent to the tasks at once, about.
ROUND = 64 << 20
#: Sources on a side of a tile, about.
TILE = 64
BILLION = 1_000_000_000
_SMOOTH = 5
#: Terms and counts that a task holds before it passes them on, and its arrays of counts.
_MEMORY = 400_000
_ARRAYS = 2_000
_BYTES = 4 << 20
#: Partial arrays that are added up in the first of two steps.
_ADDED = 64
#: Bits for each term on a level, and levels before the rest is listed.
_GAMMA = 2
_LEVELS = 24
_SEED = 42  # that of Spark's xxhash64
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and of all that is not ASCII; only A-Z are lower-cased."""
    return _TERM.findall(text.lower())


def hashes(items: list[bytes]) -> np.ndarray:
    return np.fromiter((xxh64_intdigest(t, _SEED) for t in items), np.uint64, len(items))


def _place(h: np.ndarray, level: int, size) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(h + salt) % np.asarray(size, np.uint64)).astype(np.int64)


def build(keys: list[bytes]) -> tuple[list[int], bytes, list[bytes]]:
    """Sizes of the levels, their bits in a row, and the keys in slot order.

    Keys that no level tells apart, such as those of one hash, come last.
    """
    left, sizes, bits, order = np.arange(len(keys)), [], [], []
    h = hashes(keys)
    while len(left) and len(sizes) < _LEVELS:
        size = -(-_GAMMA * len(left) // 64) * 64
        at = _place(h[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        order.append(left[own][np.argsort(at[own])])
        bits.append(np.packbits(alone, bitorder="little"))
        sizes.append(size)
        left = left[~own]
    slots = np.concatenate([*order, left]) if len(keys) else left
    return sizes, b"".join(b.tobytes() for b in bits), [keys[k] for k in slots]


class PerfectHash:
    """The shards of one language, some or all of them, searched together.

    ``shards`` are (number, sizes of levels, bits, keys) and ``among`` is the number of
    all shards of the language.
    """

    def __init__(self, shards: list[tuple[int, list[int], bytes, list[bytes]]], among: int):
        self.among = among
        self.number = np.array([s[0] for s in shards])
        self.slots = np.array([len(s[3]) for s in shards])
        self._here = np.full(among, -1)
        self._here[self.number] = np.arange(len(shards))
        words = [np.frombuffer(s[2], "<u8") for s in shards]
        self._words = np.concatenate(words) if words else np.empty(0, np.uint64)
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(self._words), dtype=np.int64)])
        levels = max((len(s[1]) for s in shards), default=0)
        self._size = np.zeros((levels, len(shards)), np.int64)
        self._start = np.zeros((levels, len(shards)), np.int64)
        bit, self._first_key, total = 0, np.zeros(len(shards), np.int64), 0
        self._first_bit = np.zeros(len(shards), np.int64)
        self._rest: dict[bytes, tuple[int, int]] = {}
        for k, (_, sizes, _, keys) in enumerate(shards):
            self._first_bit[k], self._first_key[k] = bit, total
            for level, size in enumerate(sizes):
                self._size[level, k], self._start[level, k] = size, bit
                bit += size
            total += len(keys)
        ranked = self._before[np.append(self._first_bit[1:], bit) >> 6] - self._before[self._first_bit >> 6]
        for k, (_, _, _, keys) in enumerate(shards):
            for slot in range(int(ranked[k]), len(keys)):
                self._rest[keys[slot]] = (k, slot)
        self._keys = b"".join(t for s in shards for t in s[3])
        lengths = np.fromiter((len(t) for s in shards for t in s[3]), np.int64)
        self._edges = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])

    def find(self, items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each term the position of its shard in ``number`` and its slot there; -1 for those that are no key."""
        h = hashes(items)
        shard = self._here[(h.view(np.int64) % self.among)] if self.among else np.full(len(items), -1)
        bit = np.full(len(items), -1)
        open_ = np.flatnonzero(shard >= 0)
        for level in range(len(self._size)):
            size = self._size[level, shard[open_]]
            open_, size = open_[size > 0], size[size > 0]
            if not len(open_):
                break
            at = self._start[level, shard[open_]] + _place(h[open_], level, size)
            hit = self._words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1
            bit[open_[hit]] = at[hit]
            open_ = open_[~hit]
        slot = np.full(len(items), -1)
        found = np.flatnonzero(bit >= 0)
        at = bit[found]
        below = self._words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        rank = self._before[at >> 6] + np.bitwise_count(below)
        slot[found] = rank - self._before[self._first_bit[shard[found]] >> 6]
        key = self._first_key[shard[found]] + slot[found]
        low, high = self._edges[key].tolist(), self._edges[key + 1].tolist()
        same = [self._keys[a:b] == items[k] for k, a, b in zip(found.tolist(), low, high, strict=True)]
        slot[found[~np.array(same, bool)]] = -1
        if self._rest:
            for k in np.flatnonzero((bit < 0) & (shard >= 0)).tolist():
                shard[k], slot[k] = self._rest.get(items[k], (shard[k], -1))
        return shard, slot


def packed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")


def shares(counts: np.ndarray, size: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / size) without rounding; beyond 64 bits with Python's whole numbers."""
    if len(counts) and int(counts.max()) >= (1 << 63) // BILLION - _SMOOTH:
        return np.array([1 + BILLION * (int(n) + _SMOOTH) // size for n in counts], np.int64)
    return 1 + BILLION * (counts + _SMOOTH) // size


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Columns but the text, and the text's bytes, row by row."""
    for batch in batches:
        for part in slices(batch, "text", _BYTES):
            text = part.column(0).cast(pa.binary()).to_pylist()
            yield from zip(text, *[c.to_pylist() for c in part.columns[1:]], strict=True)


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang`` and ``term`` (binary) in at least ``least`` documents of the language."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        held = 0
        for text, lang in _texts(batches):
            counter = counts[lang]
            before = len(counter)
            counter.update(set(terms(text)))
            held += len(counter) - before
            if held >= _MEMORY:
                yield from rows(counts)
                held = 0
        yield from rows(counts)

    def rows(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            yield _batch(
                {"lang": ([lang] * len(c), pa.string()), "term": (list(c), pa.binary()), "n": (list(c.values()), pa.int64())}
            )
        counts.clear()

    counted = arrow_map(docs.select("text", "lang"), of, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


_SHARDS = "lang string, shard long, among long, sizes array<long>, bits binary, terms array<binary>"


def shards_of(kept: DataFrame, size: int = SHARD) -> DataFrame:
    """A perfect hash for each shard of each language; ``terms`` are in slot order."""
    among = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias("among"))
    dealt = kept.join(among, "lang").withColumn("shard", F.expr("pmod(xxhash64(term), among)"))
    grouped = dealt.groupBy("lang", "shard", "among").agg(F.sort_array(F.collect_list("term")).alias("terms"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            built = [build(keys) for keys in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([b[0] for b in built], pa.list_(pa.int64())),
                    pa.array([b[1] for b in built], pa.binary()),
                    pa.array([b[2] for b in built], pa.list_(pa.binary())),
                ],
                ["lang", "shard", "among", "sizes", "bits", "terms"],
            )

    return arrow_map(grouped, of, _SHARDS)


def _recount(docs: DataFrame, sent) -> DataFrame:
    """Partial arrays of counts of the shards in ``sent`` for each source."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {
            lang: PerfectHash([r[1:] for r in rows], among) for (lang, among), rows in sent.value.items()
        }
        counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        arrays: dict[tuple[str, str, int], np.ndarray] = {}
        held = 0
        for text, lang, source in _texts(batches):
            if lang in tables:
                counter = counts[lang, source]
                before = len(counter)
                counter.update(terms(text))
                held += len(counter) - before
            if held >= _MEMORY:
                yield from add(tables, counts, arrays)
                held = 0
        yield from add(tables, counts, arrays)
        yield from rows(arrays)

    def add(tables, counts, arrays) -> Iterator[pa.RecordBatch]:
        for (lang, source), c in counts.items():
            table = tables[lang]
            shard, slot = table.find(list(c))
            n = np.fromiter(c.values(), np.int64, len(c))
            keep = np.flatnonzero(slot >= 0)
            keep = keep[np.argsort(shard[keep], kind="stable")]
            edges = np.append(np.flatnonzero(np.diff(shard[keep], prepend=-1)), len(keep))
            for a, b in zip(edges, edges[1:], strict=False):
                part = keep[a:b]
                k = int(shard[part[0]])
                key = lang, source, int(table.number[k])
                if key not in arrays:
                    arrays[key] = np.zeros(table.slots[k], np.int64)
                arrays[key][slot[part]] += n[part]  # a term is in the counter once
            if len(arrays) >= _ARRAYS:
                yield from rows(arrays)
        counts.clear()

    def rows(arrays) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() // _ADDED
        keys = list(arrays)
        for low in range(0, len(keys), 256):
            part = keys[low : low + 256]
            yield _batch(
                {
                    "lang": ([k[0] for k in part], pa.string()),
                    "source": ([k[1] for k in part], pa.string()),
                    "shard": ([k[2] for k in part], pa.int64()),
                    "salt": ([task] * len(part), pa.int64()),
                    "counts": ([packed(arrays[k]) for k in part], pa.binary()),
                }
            )
        arrays.clear()

    return arrow_map(
        docs.select("text", "lang", "source"), of, "lang string, source string, shard long, salt long, counts binary"
    )


def _added(rows: DataFrame, key: list[str]) -> DataFrame:
    """Arrays of equal ``key`` added up, one after the other; ``total`` is the sum of each."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, out = None, None, []
        for batch in batches:
            for *found, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                counts = unpacked(counts)
                if found == current:
                    total += counts
                    continue
                if current is not None:
                    out.append((*current, packed(total), int(total.sum())))
                current, total = found, counts.copy()
                if len(out) >= 256:
                    yield made(out)
                    out = []
        if current is not None:
            out.append((*current, packed(total), int(total.sum())))
        yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * (len(key) + 2)
        named = zip([*key, "counts", "total"], columns, strict=True)
        return _batch({name: (list(c), _TYPES[name]) for name, c in named})

    schema = ", ".join(f"{c} {'string' if c in ('lang', 'source') else 'long'}" for c in key)
    placed = rows.select(*key, "counts").repartition(*key).sortWithinPartitions(*key)
    return arrow_map(placed, of, f"{schema}, counts binary, total long")


_TYPES = {
    "lang": pa.string(),
    "source": pa.string(),
    "shard": pa.int64(),
    "salt": pa.int64(),
    "counts": pa.binary(),
    "total": pa.int64(),
}


def recount(docs: DataFrame, shards: DataFrame, space: Workspace, most: int = ROUND) -> DataFrame:
    """Counts of every kept term in each (lang, source), as an array for each shard that has any."""
    spark = docs.sparkSession
    bytes_of = "sum(length(bits) + aggregate(terms, 0L, (a, t) -> a + length(t) + 40))"
    rounds = -(-int(shards.selectExpr(f"coalesce({bytes_of}, 0) AS n").first()[0]) // most)
    parts = []
    for k in range(rounds):
        mine = shards.where(F.expr(f"pmod(xxhash64(lang, shard), {rounds}) = {k}"))
        tables: dict[tuple[str, int], list] = defaultdict(list)
        for r in mine.toLocalIterator():  # about ``most`` bytes
            tables[r.lang, r.among].append((r.lang, r.shard, r.sizes, bytes(r.bits), [bytes(t) for t in r.terms]))
        sent = spark.sparkContext.broadcast(dict(tables))
        found = _added(_recount(docs, sent), ["lang", "source", "shard", "salt"])
        parts.append(space.store(_added(found, ["lang", "source", "shard"]), f"counts-{k}"))
        sent.unpersist()
    if not parts:
        return spark.createDataFrame([], "lang string, source string, shard long, counts binary, total long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _top_terms(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms of each shard that a source uses more than its language."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], [], []
            for lang, source, counts, size, all_counts, all_size, keys in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                counts = unpacked(counts)
                value = shares(counts, size) - shares(unpacked(all_counts), all_size)
                over = np.flatnonzero((counts > 0) & (value > 0))
                best = sorted(over.tolist(), key=lambda k, v=value, t=keys: (-int(v[k]), t[k]))[:top]
                for column, values in zip(
                    out, ([lang] * len(best), [source] * len(best), [keys[k] for k in best], value[best].tolist()), strict=True
                ):
                    column.extend(values)
            types = pa.string(), pa.string(), pa.binary(), pa.int64()
            yield _batch(dict(zip(("lang", "source", "item", "value"), zip(out, types, strict=True), strict=True)))

    return arrow_map(rows, of, "lang string, source string, item binary, value long")


def _tiles(rows: DataFrame) -> DataFrame:
    """Differences of all pairs of sources in a tile of a shard, both ways."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, tile in groupby(found(batches), key=lambda r: r[:4]):
            lang, _, first, second = key
            names: dict[int, list[str]] = {first: [], second: []}
            vectors: dict[int, list[np.ndarray]] = {first: [], second: []}
            for *_, own, source, slots, counts, size in tile:
                names[own].append(source)
                vectors[own].append(shares(np.zeros(slots, np.int64) if counts is None else unpacked(counts), size))
            sources, others, values = [], [], []
            right = np.array(vectors[second], np.int64)
            for k, (name, vector) in enumerate(zip(names[first], vectors[first], strict=True)):
                skip = k + 1 if first == second else 0
                if skip < len(right):
                    value = np.abs(right[skip:] - vector).sum(axis=1).tolist()
                    sources += [name] * len(value) + names[second][skip:]
                    others += names[second][skip:] + [name] * len(value)
                    values += value * 2
            yield _batch(
                {
                    "lang": ([lang] * len(values), pa.string()),
                    "source": (sources, pa.string()),
                    "item": (others, pa.string()),
                    "value": (values, pa.int64()),
                }
            )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    return arrow_map(rows, of, "lang string, source string, item string, value long")


def audit(
    docs: DataFrame, least: int = LEAST, top: int = TOP, shard: int = SHARD, round_bytes: int = ROUND, tile: int = TILE
) -> DataFrame:
    """``lang, source, part, item, value, rank``: differences to the other sources, and the terms that stand out."""
    space = Workspace(docs.sparkSession, "divergence")
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = space.store(kept_terms(docs, least), "kept")
    shards = space.store(shards_of(kept, shard), "shards")
    counts = space.store(recount(docs, shards, space, round_bytes), "counts")

    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    occurrences = counts.groupBy("lang", "source").agg(F.sum("total").alias("n"))
    groups = docs.select("lang", "source").distinct().join(vocabulary, "lang", "left")
    groups = groups.join(occurrences, ["lang", "source"], "left").selectExpr(
        "lang", "source", "coalesce(v, 0) AS v", f"coalesce(n, 0) + {_SMOOTH} * coalesce(v, 0) AS size"
    )
    groups = space.store(groups, "groups")

    # The language itself: its sources added up, in two steps.
    salted = counts.withColumn("salt", F.expr(f"pmod(xxhash64(source), {_ADDED})"))
    whole = _added(_added(salted, ["lang", "shard", "salt"]), ["lang", "shard"])
    whole = space.store(whole.withColumnRenamed("counts", "all_counts").drop("total"), "languages")
    all_sizes = groups.groupBy("lang").agg(F.expr(f"sum(size - {_SMOOTH} * v) + {_SMOOTH} * max(v)").alias("all_size"))
    rows = (
        counts.join(groups.select("lang", "source", "size"), ["lang", "source"])
        .join(whole, ["lang", "shard"])
        .join(shards.select("lang", "shard", "terms"), ["lang", "shard"])
        .join(all_sizes, "lang")
        .select("lang", "source", "counts", "size", "all_counts", "all_size", "terms")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    found = _top_terms(rows, top).withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    found = found.withColumn("item", F.col("item").cast("string"))

    tiles = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / tile).cast("long").alias("tiles"))
    slots = shards.selectExpr("lang", "shard", "size(terms) AS slots")
    rows = (
        groups.join(tiles, "lang")
        .withColumn("own", F.expr("pmod(xxhash64(source), tiles)"))
        .join(slots, "lang")
        .join(counts.drop("total"), ["lang", "source", "shard"], "left")
        .withColumn("other", F.expr("explode(sequence(0L, tiles - 1))"))
        .selectExpr(
            "lang", "shard", "least(own, other) AS first", "greatest(own, other) AS second", "own", "source", "slots", "counts",
            "size",
        )
    )
    key = ["lang", "shard", "first", "second"]
    pairs = _tiles(rows.repartition(*key).sortWithinPartitions(*key)).groupBy("lang", "source", "item")
    pairs = pairs.agg(F.sum("value").alias("value"))
    # Without kept terms there is no shard: every pair is 0.
    bare = groups.where("v = 0").select("lang", "source")
    others = bare.select("lang", F.col("source").alias("item"))
    bare = bare.join(others, "lang").where("source != item").withColumn("value", F.lit(0).cast("long"))
    pairs = pairs.unionByName(bare).withColumn("rank", F.row_number().over(by_value))
    columns = "lang", "source", "part", "item", "value", "rank"
    return (
        pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(found.withColumn("part", F.lit("term")).select(*columns))
    )


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), w AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {LEAST}
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term
), gs AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) + {_SMOOTH} * coalesce(any_value(v), 0) AS size
  FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source LEFT JOIN v ON v.lang = g.lang
  GROUP BY g.lang, g.source
), ls AS (
  SELECT c.lang, sum(n) + {_SMOOTH} * any_value(v) AS size FROM c JOIN v USING (lang) GROUP BY c.lang
), lp AS (
  SELECT c.lang, c.term, 1 + ({BILLION}::HUGEINT * (sum(n)::HUGEINT + {_SMOOTH})) // any_value(size)::HUGEINT AS q
  FROM c JOIN ls USING (lang) GROUP BY c.lang, c.term
), gp AS (
  SELECT gs.lang, gs.source, kept.term, coalesce(n, 0) AS n,
    1 + ({BILLION}::HUGEINT * (coalesce(n, 0)::HUGEINT + {_SMOOTH})) // size::HUGEINT AS p
  FROM gs JOIN kept ON kept.lang = gs.lang
  LEFT JOIN c ON c.lang = gs.lang AND c.source = gs.source AND c.term = kept.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT gp.lang, source, 'term', gp.term, p - q
  FROM gp JOIN lp ON lp.lang = gp.lang AND lp.term = gp.term WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every
)
WHERE part = 'pair' OR rank <= {TOP}
"""
