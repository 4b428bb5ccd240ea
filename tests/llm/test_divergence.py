"""The recount against plain dictionaries, and the perfect hashes by themselves."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwright.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "ka lo MI né ÜB sa".split() for b in ["", "ta", "ru", "Çé", "漢"]]
    out = []
    for k in range(120):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "", None, "é"])
        text = rng.choice([" ", "\n", "-", "7"]).join(rng.choices(words, k=rng.randint(0, 30)))
        out.append((k, text, lang, source, 1, "x"))
    out += [(500, "only here", "fr", "s1", 1, "x"), (501, None, "fr", "s9", 1, "x"), (502, "", "fr", None, 1, "x")]
    out += [(503, "ka " * 4000, "en", "s1", 1, "x"), (None, "ka lo", "en", "s8", None, None), (504, "x", "xx", "alone", 1, "x")]
    return [*out, out[0], out[0]]


def brute(given_rows, least, top):
    docs = [(lang or "", source or "", [t.translate(UPPER) for t in TERM.findall(text or "")]) for _, text, lang, source, *_ in given_rows]
    frequency, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, found in docs:
        frequency[lang].update(set(found))
        groups[lang, source].update(found)
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in frequency.items()}

    def shares(counts, terms):
        size = sum(counts[t] for t in terms) + 5 * len(terms)
        return {t: 1 + 10**9 * (counts[t] + 5) // size for t in terms}

    out = []
    p = {g: shares(c, kept.get(g[0], [])) for g, c in groups.items()}
    for lang, source in groups:
        terms = kept.get(lang, [])
        total = sum((c for (x, _), c in groups.items() if x == lang), Counter())
        q, own = shares(total, terms), p[lang, source]
        others = [(sum(abs(own[t] - p[lang, o][t]) for t in terms), o) for x, o in groups if x == lang and o != source]
        over = [(own[t] - q[t], t) for t in terms if groups[lang, source][t] and own[t] > q[t]]
        for part, items, most in (("pair", others, None), ("term", over, top)):
            items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, i, v, k + 1) for k, (v, i) in enumerate(items)]
    return sorted(out)


@pytest.mark.parametrize("shard,round_bytes,tile", [(4, 400, 2), (divergence.SHARD, divergence.ROUND, divergence.TILE)])
def test_as_plain_counting(spark, shard, round_bytes, tile):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n long, term string")
    found = divergence.audit(docs.repartition(5), 6, 3, shard, round_bytes, tile)
    assert sorted(tuple(r) for r in found.collect()) == brute(data, 6, 3)


def test_no_kept_terms_and_no_rows(spark):
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame([(1, "a b", "en", "s1"), (2, "c", "en", "s2"), (3, "d", "de", "s1")], schema)
    assert sorted(map(tuple, divergence.audit(docs).collect())) == [
        ("en", "s1", "pair", "s2", 0, 1),
        ("en", "s2", "pair", "s1", 0, 1),
    ]
    assert divergence.audit(docs.limit(0)).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6), max_size=300), st.integers(1, 5), st.integers(0, 24))
def test_perfect_hash(keys, among, levels):
    """Every key has a slot of its own, others have none, also where keys are left after the last level."""
    before = divergence._LEVELS
    divergence._LEVELS = levels
    try:
        keys = sorted(keys)
        number = divergence.hashes(keys).view(np.int64) % among
        parts = [[k for k, n in zip(keys, number, strict=True) if n == s] for s in range(among)]
        built = [divergence.build(p) for p in parts]
    finally:
        divergence._LEVELS = before
    shards = [(s, *built[s]) for s in range(among) if s != 1]
    table = divergence.PerfectHash(shards, among)
    asked = keys + [k + b"\x00" for k in keys]
    shard, slot = table.find(asked)
    for item, s, n in zip(asked, shard.tolist(), slot.tolist(), strict=True):
        there = [(k, keys.index(item)) for k, (_, _, _, keys) in enumerate(shards) if item in keys]
        assert ([(s, n)] if n >= 0 else []) == there


def test_shares_beyond_64_bits():
    counts = np.array([0, 7, 10**18])
    assert divergence.shares(counts, 10**18 + 22).tolist() == [1 + 10**9 * (n + 5) // (10**18 + 22) for n in counts.tolist()]
    assert divergence.shares(np.array([0, 7]), 22).tolist() == [1 + 5 * 10**9 // 22, 1 + 12 * 10**9 // 22]
