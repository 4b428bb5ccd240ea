"""Words of many texts as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D. Its hash is a polynomial
in an odd base over its bytes, taken from running sums, then mixed; equal words
have equal hashes on every machine. Callers treat different hashes as different
words and equal ones as equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20
_powers = np.empty(0, np.uint64)
_inverses = np.empty(0, np.uint64)


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    global _powers, _inverses
    n = len(data)
    if len(_powers) < n:
        _powers, _inverses = _geometric(_BASE, n), _geometric(_INVERSE, n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets of the texts in them; null is empty."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Bytes that separate words: white space alone, or all of ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def hashed(texts: pa.Array, lower: bool = False, blanks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the n + 1 positions where each text's begin."""
    data, offsets = buffers(texts)
    out, ends_at = [], []
    if lower and len(data):
        data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    low = 0
    while low < len(data):
        high = min(low + _PIECE, len(data))
        while True:
            piece = data[low:high]
            blank = blanks[piece]
            if high == len(data):
                break
            edges = offsets[np.searchsorted(offsets, low, "right") : np.searchsorted(offsets, high, "right")]
            gaps = np.flatnonzero(blank)
            cut = max(edges[-1] - low if len(edges) else 0, gaps[-1] + 1 if len(gaps) else 0)
            if cut > 0:
                high = low + int(cut)
                piece, blank = data[low:high], blank[:cut]
                break
            high = min(high + _PIECE, len(data))
        inside = ~blank
        first = np.ones(len(piece), bool)
        first[1:] = blank[:-1]
        edges = offsets[np.searchsorted(offsets, low, "left") : np.searchsorted(offsets, high, "left")] - low
        first[edges] = True
        starts = np.flatnonzero(inside & first)
        last = np.ones(len(piece), bool)
        last[:-1] = blank[1:] | first[1:]
        ends = np.flatnonzero(inside & last) + 1
        if len(starts):
            out.append(_hashes(piece, starts, ends))
            ends_at.append(ends + low)
        low = high
    words = np.concatenate(out) if out else np.empty(0, np.uint64)
    ended = np.concatenate(ends_at) if ends_at else np.empty(0, np.int64)
    return words, np.searchsorted(ended, offsets, "right")


_MULTIPLIERS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words; one for all words when there are fewer."""
    n = len(words)
    if n == 0:
        return words
    if n < size:
        return mix((words * _MULTIPLIERS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total += words[k : n - size + 1 + k] * _MULTIPLIERS[k]
    return mix(total + np.uint64(size))
