"""Words grouped under their most frequent spelling, by a bit-sliced position index.

Near words differ by exactly one inserted, deleted or replaced character.

1. Words and their number of occurrences are counted before anything is shuffled.
2. Words meet in groups. For words of m characters and those of one more, one edit falls
   either into the first or into the second half of the shorter one, and leaves the other
   half as it is: so a word joins the group of its first and that of its second half, for
   its own length and for the length below. A group of more than ``GROUP`` words is cut again:
   the half with the edit has halves of its own, and words that agree in all but one
   of them make the next groups. What is left in the end differs in two characters at most,
   so its size is bounded by the number of letters; no group is ever dropped or capped.
3. Groups in a row are searched together, about ``BLOCK`` words at a time. The index
   of a block has a set of words, as bits, for each (position, letter) and for each
   length. Words in a row are looked for at once, letter by letter: the set without an
   error and three sets with one error (replaced; a letter more; a letter less) go on by
   word-parallel steps, the latter two with the positions shifted by one.
4. A word's form is its most frequent near word, if that has at least twice its number.
   Roots follow by doubling: forms are at least twice as frequent, so chains are short.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. One in
``DROPPED`` of a document's words, by a hash of document and word, loses a letter: the
noise that the groups are meant to find. Null texts have no words; a null id is the empty
text in that hash; repeated rows count again. Ties go to the first word in code-point order.
Very long texts and words are read whole. Further columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwright.llm.shared import Workspace, arrow_map, slices

LETTERS = 5
OCCURRENCES = 3
DROPPED = 97
#: Words that meet in one group before it is cut again.
GROUP = 512
#: Words of a block that is indexed at once, about.
BLOCK = 1024
#: Bits of a step's sets that are held at once: words looked for times words indexed.
_BITS = 1 << 21
#: Letters times words of a block, about, where words are very long.
_CELLS = 1 << 27
_MEMORY = 400_000
_BYTES = 4 << 20
_RUN = re.compile("[a-zÀ-ÿ]+")


def runs(text: str) -> list[str]:
    """Maximal runs of letters with A-Z lower-cased."""
    return _RUN.findall(text.lower() if text.isascii() else text.encode().lower().decode())


def words_of(doc_id: int | None, text: str) -> Counter:
    """The document's words with their number; some have lost a letter."""
    found, short = Counter(runs(text)), []
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % DROPPED == 0:
            short.append((run, h % len(run), n))
    for run, _, n in short:
        found[run] -= n
    for run, at, n in short:
        found[run[:at] + run[at + 1 :]] += n
    return found


def count_words(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """``word`` and ``n`` of all words of enough letters and occurrences."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for part in slices(batch, "text", _BYTES):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if text:
                        for word, n in words_of(doc_id, text).items():
                            if n and len(word) >= letters:
                                counts[word] += n
                        if len(counts) >= _MEMORY:
                            yield rows(counts)
                            counts.clear()
        yield rows(counts)

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    counted = arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), of, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


#: The part of a word outside a window of the shorter word's characters [low, high), with m and the window.
_KEY = "xxhash64(m, low, high, substr(word, 1, low), right(word, m - high))"


def _halves(rows: DataFrame) -> DataFrame:
    """Each row's window cut into its halves."""
    middle = "(low + high) div 2"
    window = f"explode(array(struct(low AS low, {middle} AS high), struct({middle} AS low, high AS high)))"
    cut = rows.selectExpr("word", "n", "m", f"{window} AS w").selectExpr("word", "n", "m", "w.low AS low", "w.high AS high")
    return cut.selectExpr("*", f"{_KEY} AS key")


def groups(words: DataFrame, space: Workspace, most: int = GROUP) -> DataFrame:
    """``key, word, n``: words that may be near, by groups. Every near pair shares a group.

    Keys are hashes. Two groups of one key are searched together, which changes nothing.
    """
    whole = words.selectExpr("word", "n", "explode(array(length(word) - 1, length(word))) AS m")
    rows = _halves(whole.selectExpr("word", "n", "m", "0 AS low", "m AS high").where("m > 0"))
    done = []
    while True:
        rows = space.store(rows, "windows")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("high") - F.col("low")).alias("open"))
        large = space.store(sizes.where((F.col("size") > most) & (F.col("open") > 1)).select("key"), "large")
        if large.isEmpty():
            break
        done.append(rows.join(large, "key", "left_anti"))
        rows = _halves(rows.join(large, "key", "left_semi"))
    done.append(rows)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("key", "word", "n")


class Index:
    """Bit sets of a block of words: a bit for each word, by (position, letter) and by length."""

    def __init__(self, words: list[str]):
        self.n = len(words)
        self._units = -(-self.n // 64)
        self.lengths = np.fromiter(map(len, words), np.int64, self.n)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(self.lengths)
        word = np.repeat(np.arange(self.n), self.lengths)
        position = np.arange(len(codes)) - np.repeat(ends - self.lengths, self.lengths)
        # One row of bits for each (position, letter) that occurs, and one without bits.
        cells, row = np.unique(position << 21 | codes, return_inverse=True)
        self._cells = cells
        self._bits = self._rows(len(cells) + 1, row, word)
        longest = int(self.lengths.max(initial=0))
        self._long = self._rows(longest + 3, self.lengths, np.arange(self.n))

    def _rows(self, rows: int, row: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.zeros(rows * self._units, np.uint64)
        np.bitwise_or.at(out, row * self._units + (word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))
        return out.reshape(rows, self._units)

    def _at(self, position: int, codes: np.ndarray) -> np.ndarray:
        """The words with the given letters at ``position``: a row of bits for each letter."""
        if position < 0:
            return np.zeros((len(codes), self._units), np.uint64)
        cell = position << 21 | codes
        at = np.searchsorted(self._cells, cell)
        at[self._cells[np.minimum(at, len(self._cells) - 1)] != cell] = len(self._cells)
        return self._bits[np.minimum(at, len(self._cells))]

    def near(self, codes: np.ndarray) -> np.ndarray:
        """For words of equal length, a row of letters each, the bits of the words that differ by one edit."""
        asked, m = codes.shape
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        same = np.full((asked, self._units), every)
        replaced, more, less = (np.zeros_like(same) for _ in range(3))
        for k in range(m):
            here = self._at(k, codes[:, k])
            # ``more``: the indexed word has had a letter put in before this one; ``less``: it lacks one that is past.
            more = (more | same) & self._at(k + 1, codes[:, k])
            less = less & self._at(k - 1, codes[:, k]) | same
            replaced = replaced & here | same & ~here
            same = same & here
        more |= same
        top = len(self._long) - 1
        of = lambda n: self._long[n] if 0 <= n <= top else np.zeros(self._units, np.uint64)
        return replaced & of(m) | more & of(m + 1) | less & of(m - 1)


def near_pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all near words in a list of distinct words, both ways."""
    index = Index(words)
    lefts, rights = [], []
    for m in np.unique(index.lengths).tolist():
        mine = np.flatnonzero(index.lengths == m)
        step = max(1, _BITS // max(1, index.n))
        for low in range(0, len(mine), step):
            part = mine[low : low + step]
            codes = np.frombuffer("".join(words[k] for k in part).encode("utf-32-le"), "<u4").astype(np.int64)
            found = index.near(codes.reshape(len(part), m))
            left, unit = np.nonzero(found)
            bits = np.unpackbits(found[left, unit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, bit = np.nonzero(bits)
            lefts.append(part[left[at]])
            rights.append(unit[at] * 64 + bit)
    empty = np.empty(0, np.int64)
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (empty, empty)


def _search(block: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, int] = {}
        last, letters = None, 0
        for batch in batches:
            for key, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != last and (len(words) >= block or letters * len(words) >= _CELLS):
                    yield found(words)
                    words, letters = {}, 0
                last = key
                words[word] = n
                letters += len(word)
        if words:
            yield found(words)

    def found(words: dict[str, int]) -> pa.RecordBatch:
        names, counts = list(words), list(words.values())
        left, right = (x.tolist() for x in near_pairs(names))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[k] for k in left], pa.string()),
                pa.array([names[k] for k in right], pa.string()),
                pa.array([counts[k] for k in right], pa.int64()),
            ],
            ["word", "near", "near_n"],
        )

    return of


def near_words(words: DataFrame, space: Workspace, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """``word, near, near_n``, once for every near word of a word."""
    rows = groups(words, space, group).repartition("key").sortWithinPartitions("key")
    return arrow_map(rows, _search(block), "word string, near string, near_n long").groupBy("word", "near").agg(
        F.first("near_n").alias("near_n")
    )


def variants(
    docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, group: int = GROUP, block: int = BLOCK
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the documents."""
    space = Workspace(docs.sparkSession, "spelling")
    words = space.store(count_words(docs, letters, occurrences), "words")
    # The least of (-n, word) is the most frequent near word, the first of equal ones.
    best = near_words(words, space, group, block).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("b")
    )
    found = words.join(best, "word", "left").selectExpr(
        "word",
        "n",
        "coalesce(n_near, 0) AS n_near",
        "CASE WHEN -b.n >= 2 * n THEN b.form END AS form",
        "CASE WHEN -b.n >= 2 * n THEN -b.n END AS form_n",
    )
    found = space.store(found, "forms")
    roots = found.where("form IS NOT NULL").selectExpr("word", "form AS root")
    while True:
        roots = space.store(roots, "roots")
        further = roots.selectExpr("word AS root", "root AS next")
        if roots.join(further.select("root"), "root", "left_semi").isEmpty():
            break
        roots = roots.join(further, "root", "left").selectExpr("word", "coalesce(next, root) AS root")
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
