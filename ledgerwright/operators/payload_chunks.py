"""Staging of JSON payloads that are too large for one task.

A payload, one JSON array, comes in chunks (payload_id, BudgetHeaderID, block, chunk, data)
that may be cut anywhere, also inside of a string, an escape or a character. Where a chunk
begins, the reader is outside of strings, inside of one, or behind a backslash, at some depth
of brackets. So a chunk is a function of three states to a state and a change of depth;
functions are put together within a block, and blocks within a payload. With its own state
known, each chunk is cut at the commas of depth one by a task of its own. Elements that lie
in one chunk go on at once; only those that a cut went through meet by their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwright.functions.arrow import map_batches
from ledgerwright.functions.stored import Pieces, materialize
from ledgerwright.operators.importer import typed_rows

#: States of the reader: outside of strings, inside of one, behind a backslash.
OUTSIDE, INSIDE, ESCAPED = range(3)
_QUOTE, _SLASH = ord('"'), ord("\\")
_BLANKS = b" \t\r\n"
#: Chunks that a mapping task turns into rows at once.
_ROWS = 64
_KEY = ["payload_id", "BudgetHeaderID", "block", "chunk"]


class MalformedPayload(ValueError):
    """A payload is not one JSON array."""


def scan(data: bytes, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The bytes, which of them are outside of strings, and the state behind them."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return b, np.zeros(0, bool), state
    slash = b == _SLASH
    if state == ESCAPED:
        slash[0] = False
    at = np.arange(len(b))
    # How many backslashes in a row end at each place; an odd number takes the next byte's meaning.
    run = at - np.maximum.accumulate(np.where(slash, -1, at))
    escaped = np.zeros(len(b), bool)
    escaped[1:] = slash[:-1] & (run[:-1] % 2 == 1)
    escaped[0] = state == ESCAPED
    quote = (b == _QUOTE) & ~escaped
    opened = (np.cumsum(quote) + (state != OUTSIDE)) % 2 == 1
    outside = ~opened & ~quote
    if not opened[-1]:
        return b, outside, OUTSIDE
    return b, outside, ESCAPED if slash[-1] and run[-1] % 2 == 1 else INSIDE


def _turns(b: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """+1 for every opening bracket outside of strings and -1 for every closing one."""
    opening = (b == ord("[")) | (b == ord("{"))
    closing = (b == ord("]")) | (b == ord("}"))
    return (opening & outside).astype(np.int64) - (closing & outside)


def cut(data: bytes, state: int, depth: int) -> tuple[list[tuple[int, bool, bool, bytes]], int]:
    """Segments of a chunk as (commas before, open to the left, open to the right, bytes), and its commas of depth one."""
    b, outside, _ = scan(data, state)
    turns = _turns(b, outside)
    after = depth + np.cumsum(turns)
    before = after - turns
    begins = (turns == 1) & (before == 0)
    ends = (turns == -1) & (after == 0)
    stray = outside & (before == 0) & ~begins & ~np.isin(b, list(_BLANKS))
    if stray.any() or (after < 0).any() or (b[begins] != ord("[")).any():
        raise MalformedPayload("MALFORMED payload: it is not one JSON array")
    comma = outside & (before == 1) & (b == ord(",")) & (turns == 0)
    edges = np.flatnonzero(begins | ends | comma).tolist()
    out, commas, start, left = [], 0, 0, True
    within = depth > 0
    for edge in edges:
        if within:
            out.append((commas, left, False, data[start:edge]))
        if comma[edge]:
            commas += 1
        within = not ends[edge]
        start, left = edge + 1, False
    if within:
        out.append((commas, left, True, data[start:]))
    return out, commas


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state and the change of depth behind a chunk, for each state before it."""
    for batch in batches:
        to, depth = [], []
        for data in batch.column(4).to_pylist():
            found = [scan(data, s) for s in range(3)]
            to.append([f[2] for f in found])
            depth.append([int(_turns(f[0], f[1]).sum()) for f in found])
        columns = [pa.array(to, pa.list_(pa.int32())), pa.array(depth, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns], [*_KEY, "to", "depth"])


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For sorted rows (group, order, to, depth): the functions of all rows of the group before each row, and with it."""
    group, to, depth = None, [], []
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for g, t, d in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3)], strict=True):
            if g != group:
                group, to, depth = g, [0, 1, 2], [0, 0, 0]
            after = [t[s] for s in to]
            deeper = [n + d[s] for n, s in zip(depth, to, strict=True)]
            for column, value in zip(out, (to, depth, after, deeper), strict=True):
                column.append(value)
            to, depth = after, deeper
        types = [pa.list_(pa.int32()), pa.list_(pa.int64())] * 2
        columns = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
        names = ["group", "place", "was", "was_depth", "to", "depth"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names)


def _in_order(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    placed = rows.select(F.struct(*group).alias("group"), F.col(order).alias("place"), "to", "depth")
    placed = placed.repartition(*[F.col("group")[c] for c in group]).sortWithinPartitions("group", "place")
    types = {f.name: f.dataType.simpleString() for f in placed.schema}
    lists = "was array<int>, was_depth array<long>, to array<int>, depth array<long>"
    out = map_batches(placed, _composed, f"group {types['group']}, place {types['place']}, {lists}")
    return out.selectExpr(*[f"group.{c} AS {c}" for c in group], f"place AS {order}", "was", "was_depth", "to", "depth")


def chunk_states(chunks: DataFrame) -> DataFrame:
    """``state`` and ``depth`` of the reader where each chunk begins. A payload that does not end closed is an error."""
    functions = map_batches(
        chunks.select(*_KEY, "data"), _functions, "payload_id string, BudgetHeaderID long, block long, chunk long, to array<int>, depth array<long>"
    )
    within = materialize(_in_order(functions, _KEY[:3], "chunk"), "chunk-functions")
    last = F.max_by(F.struct("to", "depth"), F.col("chunk")).alias("f")
    blocks = within.groupBy(*_KEY[:3]).agg(last).selectExpr(*_KEY[:3], "f.to", "f.depth")
    blocks = materialize(_in_order(blocks, _KEY[:2], "block"), "block-functions")
    closed = "assert_true(max_by(to[0] = 0 AND depth[0] = 0, block), 'MALFORMED payload: it does not end')"
    checked = blocks.groupBy(*_KEY[:2]).agg(F.expr(closed).alias("closed"))
    starts = blocks.join(checked, _KEY[:2]).where("closed IS NULL").selectExpr(
        *_KEY[:3], "was[0] AS block_state", "was_depth[0] AS block_depth"
    )
    return within.join(starts, _KEY[:3]).selectExpr(
        *_KEY, "was[block_state] AS state", "block_depth + was_depth[block_state] AS depth"
    )


_SEGMENTS = "payload_id string, BudgetHeaderID long, block long, chunk long, n int, whole boolean, data binary, commas int"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*_KEY, "n", "whole", "data", "commas"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int32()]
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            rows = []
            for *key, data, state, depth in zip(*[c.to_pylist() for c in batch.slice(low, _ROWS).columns], strict=True):
                found, commas = cut(data, state, depth)
                rows += [(*key, n, not (left or right), part, commas) for n, left, right, part in found]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def payload_elements(chunks: DataFrame) -> DataFrame:
    """``payload_id, BudgetHeaderID, row_id, element`` (text) of chunked payloads; ``row_id`` counts from 1."""
    chunks = chunks.selectExpr(
        "CAST(payload_id AS STRING) AS payload_id", "CAST(BudgetHeaderID AS BIGINT) AS BudgetHeaderID",
        "CAST(block AS BIGINT) AS block", "CAST(chunk AS BIGINT) AS chunk", "coalesce(CAST(data AS BINARY), X'') AS data",
    )
    held = Pieces(chunks.sparkSession, "payload-chunks")
    held.add(chunks)
    chunks = held.rows()
    placed = chunks.join(chunk_states(chunks), _KEY).select(*_KEY, "data", "state", "depth")
    parts = materialize(map_batches(placed, _segments, _SEGMENTS), "segments")
    # The segments have all of the chunks' text, so the chunks need not be kept beside them.
    held.drop()

    # Commas of earlier blocks, and of earlier chunks of the block.
    counts = materialize(parts.groupBy(*_KEY).agg(F.max("commas").alias("commas")), "commas")
    of_block = counts.groupBy(*_KEY[:3]).agg(F.sum("commas").alias("commas"))

    def earlier(group: list[str], order: str) -> F.Column:
        window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("commas").over(window), F.lit(0))

    # A payload without commas of depth one has one element or none.
    single = (F.sum("commas").over(Window.partitionBy(*_KEY[:2])) == 0).alias("single")
    of_block = of_block.select(*_KEY[:3], earlier(_KEY[:2], "block").alias("block_before"), single)
    counts = counts.select(*_KEY, earlier(_KEY[:3], "chunk").alias("before"))
    counts = counts.join(of_block, _KEY[:3]).selectExpr(*_KEY, "block_before + before AS before", "single")
    parts = parts.join(counts, _KEY).withColumn("row_id", F.expr("CAST(before + n + 1 AS INT)"))

    whole = parts.where("whole").selectExpr(*_KEY[:2], "row_id", "CAST(data AS STRING) AS element", "single")
    cuts = parts.where("NOT whole").groupBy(*_KEY[:2], "row_id").agg(
        F.expr(
            "CAST(unhex(array_join(transform(array_sort(collect_list(struct(block, chunk, data))), x -> hex(x.data)), ''))"
            " AS STRING)"
        ).alias("element"),
        F.expr("bool_or(single)").alias("single"),
    )
    found = whole.unionByName(cuts)
    # An array without elements has one blank segment; behind a comma, a blank one is an error that parsing finds.
    found = found.where("NOT (single AND trim(BOTH ' \\t\\r\\n' FROM element) = '')")
    return found.select(*_KEY[:2], "row_id", "element")


def import_chunk_rows(chunks: DataFrame) -> DataFrame:
    """Typed rows of chunked payloads, as ``import_payload_rows`` gives them for whole ones."""
    return typed_rows(payload_elements(chunks).withColumn("value", F.parse_json("element")))


def read_payload_chunks(spark: SparkSession, *paths: str, budget: int, commas: int = 10_000) -> DataFrame:
    """Chunks of JSON files, one payload a file, for the given budget.

    Spark splits a file over tasks at commas, so a file without a line end is read by many
    tasks too. A split is a block; ``commas`` pieces in a row are a chunk.
    """
    rows = spark.read.text(list(paths), lineSep=",").selectExpr(
        "input_file_name() AS payload_id", "_metadata.file_block_start AS block", "monotonically_increasing_id() AS at",
        "_metadata.file_size AS size", "value",
    )
    pieces = "array_join(transform(array_sort(collect_list(struct(at, value))), x -> x.value), ',')"
    rows = rows.groupBy("payload_id", "block", F.expr(f"at div {commas}").alias("chunk")).agg(F.expr(pieces).alias("text"))
    # A comma stands before every chunk but the first one of a file.
    first = Window.partitionBy("payload_id").orderBy("block", "chunk")
    order = rows.select("payload_id", "block", "chunk").withColumn("first", F.row_number().over(first) == 1)
    return rows.join(order, ["payload_id", "block", "chunk"]).selectExpr(
        "payload_id", f"CAST({budget} AS BIGINT) AS BudgetHeaderID", "block", "chunk",
        "CAST(IF(first, text, concat(',', text)) AS BINARY) AS data",
    )
