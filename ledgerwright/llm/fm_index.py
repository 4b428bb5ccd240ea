"""A compressed full-text index over word numbers, with searches in lockstep for many patterns.

The suffixes of the text are sorted by their first ``depth`` symbols. The column of the
symbols before them is held as a wavelet matrix: one bit vector for each bit of a
symbol, with a running count every 64 bits. Backward search on this column gives the
interval of any pattern of up to ``depth`` symbols.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector that counts the ones before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        padded[: len(packed)] = packed
        self._words = padded.view(np.uint64)
        ones = np.bitwise_count(self._words).astype(np.int64)
        self._before = np.concatenate([[0], np.cumsum(ones)[:-1]])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & low)


class WaveletMatrix:
    """Counts a symbol before a position of a sequence of numbers."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self._levels = []
        for bit in reversed(range(max(1, int(largest).bit_length()))):
            ones = (symbols >> bit) & 1 == 1
            zeros = len(symbols) - int(ones.sum())
            self._levels.append((bit, Bits(ones), zeros))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self._first = self._down(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self._levels:
            ones = bits.ones(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self._first[symbol]


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense numbers of the keys in their order."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), np.int64)
    new[0] = 0
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out


class FMIndex:
    """An index of a text of numbers >= 1, in which 0 ends each of its segments.

    ``depth`` is the length of the patterns that matter; symbols beyond the text count as 0.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.depth = depth

        def joined(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
            later = np.zeros(n, np.int64)
            later[: n - step] = b[step:] + 1 if n > step else 0
            return _ranks(a * (n + 2) + later)

        rank, length = _ranks(text), 1
        shorter = rank
        while length < depth:
            step = min(length, depth - length)
            # The prefix of depth - 1 symbols is needed too, for dropping a pattern's last symbol.
            if length + step == depth:
                shorter = joined(rank, rank, step - 1) if step > 1 else rank
            rank = joined(rank, rank, step)
            length += step
        self.order = np.argsort(rank, kind="stable")
        before = text[self.order - 1]
        self.symbols = int(text.max())
        self._column = WaveletMatrix(before, self.symbols)
        counts = np.bincount(text, minlength=self.symbols + 1)
        self._less = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.group = self._groups(rank)
        self._wide = self._groups(shorter)

    def _groups(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end, for each place in the order, of the places that share its prefix."""
        sorted_ = rank[self.order]
        begins = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        size = np.diff(np.append(begins, len(rank)))
        return np.repeat(begins, size), np.repeat(begins + size, size)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with a symbol put before them."""
        return (
            self._less[symbol] + self._column.rank(symbol, low),
            self._less[symbol] + self._column.rank(symbol, high),
        )

    def drop_last(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of patterns of ``depth`` symbols after their last one is dropped."""
        return self._wide[0][low], self._wide[1][low]


def matching(index: FMIndex, patterns: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Intervals of every window of ``depth`` symbols of the patterns, as (pattern, offset, low, high) arrays.

    Matching statistics cut off at ``depth``: each pattern is read from its end, one
    symbol is put before the match, and when the match has ``depth`` symbols its last
    one is dropped first. Where no symbol can be put before, every window with the match
    and that symbol is ruled out, and the search goes on with windows that end one symbol
    earlier; before a symbol that the text lacks, none that holds it is tried.
    """
    depth = index.depth
    active = np.flatnonzero(lengths >= depth)
    offset = np.asarray(lengths, np.int64) - 1
    low = np.zeros(len(lengths), np.int64)
    high = np.full(len(lengths), len(index.order), np.int64)
    matched = np.zeros(len(lengths), np.int64)
    while len(active):
        full = active[matched[active] == depth]
        low[full], high[full] = index.drop_last(low[full])
        matched[full] -= 1
        symbol = patterns[starts[active] + offset[active]]
        known = symbol <= index.symbols
        a, b = index.extend(np.where(known, symbol, 0), low[active], high[active])
        good = known & (a < b)
        went, broke = active[good], active[~good]
        low[went], high[went] = a[good], b[good]
        matched[went] += 1
        offset[went] -= 1
        end = offset[broke] + np.where(known[~good], matched[broke], 0)
        low[broke], high[broke], matched[broke], offset[broke] = 0, len(index.order), 0, end - 1
        hit = went[matched[went] == depth]
        yield hit, offset[hit] + 1, low[hit], high[hit]
        # Left are patterns in which a window still fits before the end of the match.
        active = active[offset[active] + 1 + np.minimum(matched[active], depth - 1) >= depth]
