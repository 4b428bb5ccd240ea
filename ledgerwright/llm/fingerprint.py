"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame operations only.

A text is cut into pieces: runs of up to ``PIECE`` words within a line. The digests of
its distinct pieces go into a sketch of ``CELLS`` cells: each digest is in one cell of
each of three parts, and a cell holds how many digests it has and the XOR of the digests
and of their check hashes. The fingerprint writes the number of digests and the cells.

Two sketches of one size subtract cell by cell. What is left holds the digests that only
one text has. A cell with a count of one and a fitting check hash gives its digest away;
taking that out of its other cells opens more of them (peeling). A sketch too small for
the difference does not empty; such pairs are tried again with a larger one, first of
twice the digests of both texts, then doubling with other hashes, until all are empty.
The likeness of two texts is 1 minus the differing share of their digests.

All cells of a pair stay in one partition: a pair is one row in the only shuffle of an
attempt, and the turns of peeling are aggregates within it.

Null texts are empty and have no digests; two texts without any have likeness 1.
Documents follow each other by descending id, rows of one id by the hash of their text,
null ids last; equal rows count as one document, and each gets its values.
Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.llm.shared import Workspace, plain_operators

PIECE = 16
CELLS = 24
#: Turns of peeling in an attempt, one part of the cells after the other. A task holds an aggregation for each.
TURNS = 7
#: Least digests of two texts from which their difference is estimated.
LEAST = 32
#: Digests of a task in an attempt, on average; all turns of a task run at once.
DIGESTS = 50_000
_PIECES = rf"\S++(?:[^\S\n]++\S++){{0,{PIECE - 1}}}+"
#: Stands for a null id in keys.
_NO_ID = -(1 << 63)
_KEY = ["id", "hash"]


def digests(text: Column) -> Column:
    """Sorted distinct digests of the pieces of a text."""
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p))))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(97))


def _place(digest: Column, part: int, cells: Column, attempt: int) -> Column:
    """The digest's cell in one of the three parts of a sketch."""
    size = (cells / 3).cast("long")
    return F.lit(part) * size + F.pmod(F.xxhash64(digest, F.lit(3 * attempt + part)), size)


def sketch_text(found: Column) -> Column:
    """The fingerprint of sorted distinct digests."""
    size = CELLS // 3
    parts = []
    for part in range(3):
        inside = F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)),
            lambda i, part=part: F.filter(found, lambda d: F.pmod(F.xxhash64(d, F.lit(part)), F.lit(size)) == i),
        )
        cell = F.transform(
            inside,
            lambda ds: F.concat_ws(
                ".",
                F.hex(F.size(ds)),
                F.hex(F.aggregate(ds, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(d))),
                F.hex(F.aggregate(ds, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(_check(d)))),
            ),
        )
        parts.append(cell)
    return F.concat(F.hex(F.size(found)), F.lit(":"), F.array_join(F.concat(*parts), "-"))


def _followers(space: Workspace, keyed: DataFrame) -> DataFrame:
    """id, hash, next_id, next_hash, third (of the characters) and copies for all distinct documents.

    Keys are range-partitioned and stored with their partition; the next key is the
    next one there, or the first one of the next partition, or of the first.
    """
    keys = keyed.select(*_KEY, F.length("text").alias("n")).groupBy(*_KEY, "n").agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("id").desc(), F.col("hash")]
    placed = space.store(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order")
    in_part = Window.partitionBy("part").orderBy(*order)
    inner = placed.withColumn("next", F.lead(F.struct(*_KEY)).over(in_part))
    # A row for each partition.
    heads = placed.groupBy("part").agg(F.min(F.struct(F.bitwise_not("id").alias("turned"), "hash")).alias("head"))
    heads = heads.select("part", F.struct(F.bitwise_not("head.turned").alias("id"), F.col("head.hash").alias("hash")).alias("head"))
    by_part = Window.orderBy("part")
    after = heads.select("part", F.lead("head").over(by_part).alias("after"), F.first("head").over(by_part).alias("first"))
    after = space.store(after.select("part", F.coalesce("after", "first").alias("after")), "heads")
    return space.store(
        inner.join(after, "part").select(
            *_KEY,
            F.coalesce("next", "after")["id"].alias("next_id"),
            F.coalesce("next", "after")["hash"].alias("next_hash"),
            F.expr("n div 3").cast("int").alias("third"),
            "copies",
        ),
        "followers",
    )


def _turn(cells: DataFrame, part: int, attempt: int) -> DataFrame:
    """One turn of peeling by the cells of one part. The cell -1 of a pair counts the digests found."""
    mine = F.expr(f"cell >= {part} * (size div 3) AND cell < {part + 1} * (size div 3)")
    pure = mine & (F.abs("n") == 1) & (F.col("checks") == _check(F.col("keys")))
    nothing = F.lit(0).cast("long")

    def row(cell, n, keys, checks):
        return F.struct(cell.alias("cell"), n.alias("n"), keys.alias("keys"), checks.alias("checks"))

    own = row(F.col("cell"), F.col("n"), F.col("keys"), F.col("checks"))
    # The cell itself is empty after this: only the two others and the count are left of it.
    taken = [
        row(_place(F.col("keys"), j, F.col("size"), attempt), -F.col("n"), F.col("keys"), F.col("checks"))
        for j in range(3)
        if j != part
    ]
    counted = row(F.lit(-1).cast("long"), F.lit(1).cast("long"), nothing, nothing)
    rows = cells.select(*_KEY, "kind", "size", F.explode(F.when(pure, F.array(*taken, counted)).otherwise(F.array(own))).alias("r"))
    return _summed(rows.select(*_KEY, "kind", "size", "r.*"))


def _summed(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(*_KEY, "kind", "size", "cell")
        .agg(F.sum("n").alias("n"), F.bit_xor("keys").alias("keys"), F.bit_xor("checks").alias("checks"))
        .where("cell = -1 OR n != 0 OR keys != 0 OR checks != 0")
    )


def _estimated(left: Column, right: Column) -> Column:
    """Cells for the digests that only one of two texts has, by the shared part of their least digests; both are sorted."""
    l_, r_ = F.slice(left, 1, LEAST), F.slice(right, 1, LEAST)
    least = F.slice(F.array_sort(F.array_union(l_, r_)), 1, LEAST)
    shared = F.size(F.array_intersect(F.array_intersect(least, l_), r_)) / F.size(least)
    differing = (F.size(left) + F.size(right)) * (1 - shared) / (1 + shared)
    return (F.ceil(differing * 2 / 3) * 3 + CELLS).cast("long")


def _of_kinds(kinds: list[DataFrame]) -> DataFrame:
    pairs = [k.select(*_KEY, F.lit(n).alias("kind"), "left", "right") for n, k in enumerate(kinds)]
    return reduce(DataFrame.unionAll, pairs)


def difference_sizes(space: Workspace, kinds: list[DataFrame]) -> DataFrame:
    """id, hash, kind and differing (digests in one of ``left`` and ``right`` only) for all pairs.

    Pairs (id, hash, left, right) come by kind. Those of a later attempt are picked where they are stored.
    """
    out, attempt = None, 0
    todo = _of_kinds(kinds).withColumn("size", _estimated(F.col("left"), F.col("right")))
    while True:
        both = F.concat(
            F.transform("left", lambda d: F.struct(d.alias("d"), F.lit(1).cast("long").alias("n"))),
            F.transform("right", lambda d: F.struct(d.alias("d"), F.lit(-1).cast("long").alias("n"))),
        )
        count = todo.agg(F.sum(F.size("left") + F.size("right"))).first()[0] or 0
        dealt = todo.repartition(max(1, -(-count // DIGESTS)), *_KEY)
        signed = dealt.select(*_KEY, "kind", "size", F.explode(both).alias("x")).select(*_KEY, "kind", "size", "x.d", "x.n")
        places = F.array(*[_place(F.col("d"), j, F.col("size"), attempt) for j in range(3)])
        cells = signed.select(*_KEY, "kind", "size", "n", "d", F.explode(places).alias("cell"))
        cells = _summed(cells.select(*_KEY, "kind", "size", "cell", "n", F.col("d").alias("keys"), _check(F.col("d")).alias("checks")))
        for turn in range(TURNS):
            cells = _turn(cells, turn % 3, attempt)
        result = cells.groupBy(*_KEY, "kind").agg(
            F.sum(F.when(F.col("cell") == -1, F.col("n"))).alias("differing"),
            F.max(F.col("cell") >= 0).alias("stuck"),
        )
        # Generated code would make one method of all turns; their plain operators need less memory.
        with plain_operators(space.spark):
            result = space.store(result, "peeled")
        good = result.where("NOT stuck").select(*_KEY, "kind", "differing")
        out = good if out is None else out.unionAll(good)
        stuck = result.where("stuck").select(*_KEY, "kind")
        if not stuck.limit(1).count():
            return out
        attempt += 1
        wide = f"((size(left) + size(right)) * {1 << attempt} div 3) * 3 + {CELLS}"
        again = [k.join(stuck.where(F.col("kind") == n).select(*_KEY), _KEY, "left_semi") for n, k in enumerate(kinds)]
        todo = _of_kinds(again).withColumn("size", F.expr(wide).cast("long"))


def fingerprints(docs: DataFrame, space: Workspace | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next for every row (doc_id, text).

    The edited text has its last third replaced by the beginning of the next document.
    """
    space = space or Workspace(docs.sparkSession, "fingerprint")
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    followers = _followers(space, keyed)
    # Both joins read one shuffle of the texts.
    distinct = keyed.groupBy(*_KEY).agg(F.first("text").alias("text"))
    heads = (
        distinct.join(
            followers.select(
                F.col("next_id").alias("id"), F.col("next_hash").alias("hash"),
                F.col("id").alias("own_id"), F.col("hash").alias("own_hash"), "third",
            ).hint("merge"),
            _KEY,
        )
        .select(F.col("own_id").alias("id"), F.col("own_hash").alias("hash"), F.expr("substring(text, 1, third)").alias("head"))
    )
    edited = distinct.join(heads.hint("merge"), _KEY).select(
        *_KEY,
        F.length("text").cast("long").alias("n_chars"),
        F.concat(F.expr("substring(text, 1, length(text) - length(text) div 3)"), "head").alias("edited"),
        digests(F.col("text")).alias("left"),
    )
    rows = space.store_by(
        edited.select(
            *_KEY, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "left", digests(F.col("edited")).alias("right")
        ),
        "digests",
        *_KEY,
    )
    # A document and its edited text are a pair as they are stored; only pairs with the next one are put together.
    nexts = rows.select(F.col("id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("left").alias("right"))
    to_next = followers.select(*_KEY, "next_id", "next_hash").join(nexts, ["next_id", "next_hash"])
    to_next = to_next.join(rows.select(*_KEY, "left"), _KEY).select(*_KEY, "left", "right")
    kinds = [rows.select(*_KEY, "left", "right"), space.store_by(to_next, "next", *_KEY)]
    sized = _of_kinds(kinds).select(*_KEY, "kind", (F.size("left") + F.size("right")).alias("total"))
    differing = space.store(difference_sizes(space, [k.where("size(left) + size(right) > 0") for k in kinds]), "differing")
    likeness = F.coalesce(1 - F.coalesce("differing", F.lit(0)) / F.nullif(F.col("total"), F.lit(0)), F.lit(1.0))
    near = (
        sized.join(differing, [*_KEY, "kind"], "left")
        .withColumn("likeness", likeness)
        .groupBy(*_KEY)
        .agg(
            F.max(F.when(F.col("kind") == 0, F.col("likeness"))).alias("near_edited"),
            F.max(F.when(F.col("kind") == 1, F.col("likeness"))).alias("near_next"),
        )
    )
    each = rows.join(space.store(near, "near"), _KEY).join(followers.select(*_KEY, "copies"), _KEY)
    prints = [sketch_text(F.col("left")).alias("fingerprint"), sketch_text(F.col("right")).alias("edited_fingerprint")]
    once = each.select(*_KEY, "copies", "n_chars", "edited_sha256", *prints, "near_edited", "near_next")
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
