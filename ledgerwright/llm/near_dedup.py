"""MinHash near-duplicate documents by an LSH forest.

Every distinct shingle set gets a signature of ``TREES`` x ``DEPTH`` minimum hashes.
A tree is the order of all signatures by its own DEPTH values; the trees are sorted
runs of one range-partitioned table. Two sets are candidates when they are neighbours
in a run and share a prefix of at least ``least`` values:

* where at most ``WINDOW`` sets share the prefix, all of them are neighbours;
* in denser regions a set meets the sets next to it only, which share its longest
  prefixes, so the depth follows the density. Each such region is then compared with
  its hubs, the sets with most confirmed links, while that joins much of the region.
  Sets of a region that are still apart meet by an exact prefix join (see hubs.py).

Candidates become links only by the exact similarity of their full shingle sets, and
links become components. No group is collected: regions of any size are rows in
sorted runs, and equal sets are reduced to one before anything else.

Nulls, empty texts and texts without words have no shingles and are linked with
nothing. A null id is no document's name: such rows keep a null component and stay.
Repeated rows of one id give one result row each; the id is linked by any of its texts. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.llm import words
from ledgerwright.llm.hubs import hub_components
from ledgerwright.llm.shared import Workspace, arrow_map, slices

TREES = 16
DEPTH = 8
WINDOW = 16
#: Neighbours on each side in dense regions.
BESIDE = 3
#: Trees whose dense regions are compared with hubs. At similarity 0.85 and four shared values a
#: set misses its hub's regions in all of them with probability (1 - 0.85^4)^10 = 0.06 %.
HUB_TREES = 10
_BYTES = 4 << 20

_FIRST = words.mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_MULTIPLY = ((_FIRST >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)[:, None]
_CELL = words.mix(np.arange(1, DEPTH + 1, dtype=np.uint64)) | np.uint64(1)
_TURN = (_FIRST & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None]


def signature(shingles: np.ndarray) -> bytes:
    """Minimum of every hash function, each as four big-endian bytes."""
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(low), 2048):
        x = (low[None, at : at + 2048] ^ _TURN) * _MULTIPLY
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(least, x.min(axis=1), out=least)
    return least.astype(">u4").tobytes()


def _sets(batches: Iterator[pa.RecordBatch], size: int, lower: bool) -> Iterator[tuple[pa.RecordBatch, list]]:
    for whole in batches:
        for batch in slices(whole, "text", _BYTES):
            hashes, at = words.hashed(batch.column(batch.schema.get_field_index("text")), lower)
            yield batch, [np.unique(words.shingles(hashes[i:j], size)) for i, j in zip(at[:-1], at[1:], strict=True)]


def signatures(docs: DataFrame, size: int, lower: bool) -> DataFrame:
    """doc_id, n_shingles, set_key (of the whole set), signature; null key and signature for empty sets."""

    def of(batches):
        for batch, sets in _sets(batches, size, lower):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_key", "signature"],
            )

    return arrow_map(
        docs.select(F.col("doc_id").cast("long"), "text"),
        of,
        "doc_id long, n_shingles long, set_key binary, signature binary",
    )


def _neighbours(least: int):
    """Pairs (a, b) of neighbours, and members (cell, a) of regions beyond ``WINDOW`` with b null."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, key, doc = np.empty(0, np.int32), np.empty((0, DEPTH), np.uint32), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            old = len(doc)
            tree = np.concatenate([tree, batch.column(0).to_numpy()])
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, DEPTH)
            key = np.concatenate([key, raw.astype(np.uint32)])
            doc = np.concatenate([doc, batch.column(2).to_numpy()])

            def near(o, tree=tree, key=key):
                """Whether rows share a prefix with the row ``o`` before; False for the first rows."""
                out = np.zeros(len(tree), bool)
                if o < len(tree):
                    out[o:] = (tree[o:] == tree[:-o]) & (key[o:, :least] == key[:-o, :least]).all(axis=1)
                return out

            dense = near(WINDOW)
            found = []
            for o in range(1, WINDOW):
                rows = near(o)
                if o > BESIDE:
                    rows &= ~dense
                rows = np.flatnonzero(rows)
                rows = rows[(rows >= old) & (doc[rows] != doc[rows - o])]
                found.append(np.stack([doc[rows], doc[rows - o]]))
            a, b = np.concatenate(found, axis=1)
            inside = np.flatnonzero(dense & (tree < HUB_TREES))
            inside = np.unique(inside[:, None] - np.arange(WINDOW + 1))
            cell = words.mix(key[inside, :least].astype(np.uint64) @ _CELL[:least] + tree[inside].astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.maximum(a, b), doc[inside]])),
                    pa.concat_arrays([pa.array(np.minimum(a, b)), pa.nulls(len(inside), pa.int64())]),
                    pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(cell.view(np.int64))]),
                ],
                ["a", "b", "cell"],
            )
            keep = max(0, len(doc) - WINDOW)
            tree, key, doc = tree[keep:], key[keep:], doc[keep:]

    return of


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _confirm(percent: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                small, large = sorted((len(x), len(y)))
                if 100 * small < percent * large:
                    good.append(False)
                    continue
                s = _shared(x, y)
                good.append(100 * s >= percent * (small + large - s))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return of


def _of_one_id(members: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of an id that has several texts; most ids have one, and none of these."""
    of = members.where("class IS NOT NULL").select("doc_id", F.col("class").alias("a"))
    least = of.groupBy("doc_id").agg(F.min("a").alias("b"), F.max("a").alias("most")).where("b < most").select("doc_id", "b")
    return of.join(least, "doc_id").where("a > b").select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, lower: bool = False, least: int = 4, space: Workspace | None = None
) -> DataFrame:
    """doc_id, n_shingles, n_links, component_id and kept of every row of ``docs`` (doc_id, text).

    Documents are linked when 100 x shared >= ``percent`` x joint ``size``-word
    shingles. ``n_links`` counts the confirmed candidate links of the document's set,
    and those to the other sets of one id.
    """
    space = space or Workspace(docs.sparkSession, "near-dedup")
    signed = space.store(signatures(docs, size, lower), "signatures")
    classes = space.store(
        signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("class"), F.first("signature").alias("signature")),
        "classes",
    )
    width = 4 * DEPTH
    trees = classes.select(F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "class", "signature").select(
        "tree", F.expr(f"substring(signature, tree * {width} + 1, {width})").alias("key"), F.col("class").alias("doc_id")
    )
    ordered = trees.repartitionByRange("tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id")
    near = space.store(arrow_map(ordered, _neighbours(least), "a long, b long, cell long"), "neighbours")
    pairs = space.store(near.where("cell IS NULL").select("a", "b").distinct(), "pairs")
    dense = near.where("cell IS NOT NULL").select("cell", F.col("a").alias("node"))
    nodes = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()

    def full(batches):
        for batch, found in _sets(batches, size, lower):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in found], pa.binary())], ["doc_id", "shingles"]
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text").join(nodes.hint("merge"), "doc_id", "left_semi")
    full_sets = arrow_map(texts, full, "doc_id long, shingles binary")
    full_sets = space.store(full_sets, "shingles")

    def confirmed(candidates: DataFrame) -> DataFrame:
        both = (
            candidates.join(full_sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(full_sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", "x", "y")
        )
        return space.store(arrow_map(both, _confirm(percent), "a long, b long").distinct(), "confirmed")

    def unpacked(batches):
        for batch in batches:
            packed = batch.column(1)
            values = np.frombuffer(b"".join(packed.to_pylist()), np.int64)
            at = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.binary_length(packed)) // 8)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(values))], ["node", "pieces"]
            )

    def sets(of: DataFrame) -> DataFrame:
        wanted = full_sets.join(of.select(F.col("node").alias("doc_id")).hint("merge"), "doc_id", "left_semi").distinct()
        return arrow_map(wanted, unpacked, "node long, pieces array<long>").withColumn("key", F.xxhash64("pieces"))

    members = signed.select("doc_id", "n_shingles", "set_key").join(classes.select("set_key", "class"), "set_key", "left")
    known = confirmed(pairs).unionAll(_of_one_id(members))
    component, links = hub_components(space, dense, pairs, known, confirmed, confirmed, sets, percent)
    ends = links.select(F.col("a").alias("class")).unionAll(links.select("b"))
    degree = space.store(ends.groupBy("class").agg(F.count(F.lit(1)).alias("n_links")), "degrees")
    found = component.select(F.col("node").alias("class"), "component")
    return (
        members.join(found, "class", "left")
        .join(degree, "class", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "class", "doc_id").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept", "n_links")
    )

