"""Near words against an edit distance, and the whole operator against plain dictionaries."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwright.llm import spelling
from ledgerwright.llm.shared import Workspace

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """One inserted, deleted or replaced character apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def rows():
    rng = random.Random(11)
    stems = ["".join(rng.choices("abcdeé", k=rng.randint(3, 9))) for _ in range(40)]
    texts = []
    for _ in range(150):
        out = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(stems)
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w, w, w, w[:at] + w[at + 1 :], w[:at] + rng.choice("abÀÿ×") + w[at:], w.upper(), w + "x" * 40])
            out.append(w)
        texts.append(rng.choice([" ", "-", "\n", "1"]).join(out))
    texts += [None, "", " ", "aaaaa " * 3000, "z" * 5000 + " " + "z" * 4999 + " " + "z" * 5000, "漢字漢字漢字 ßßßßßß Ååååååå"]
    texts += ["z" * 5000, "z" * 4999, "z" * 4999, "qwerty " * 100 + "qwertz " * 40 + "qwertzu " * 15 + "qwerti " * 40]
    out = [(k, t, 1, "x") for k, t in enumerate(texts)]
    return [*out, out[1], out[1], (None, "abcde abcde abcde", 1, "x"), (None, None, None, None)]


def counted(data):
    counts = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(data):
    words = counted(data)
    out, forms = [], {}
    for w, n in words.items():
        close = sorted((-words[x], x) for x in words if abs(len(x) - len(w)) < 2 and near(w, x))
        form = close[0] if close and -close[0][0] >= 2 * n else (None, None)
        forms[w] = form[1]
        out.append([w, n, len(close), form[1], None if form[0] is None else -form[0]])
    for row in out:
        root = row[0]
        while forms[root] is not None:
            root = forms[root]
        row.append(root)
    return sorted(map(tuple, out))


@pytest.mark.parametrize("group,block", [(2, 1), (20, 50), (spelling.GROUP, spelling.BLOCK)])
def test_as_plain_dictionaries(spark, group, block):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string, n int, word string").repartition(4)
    found = spelling.variants(docs, group=group, block=block)
    found = found.select("word", "n", "n_near", "form", "form_n", "root").collect()
    expected = brute(data)
    assert any(r[3] is not None and r[3] != r[5] for r in expected)  # a chain of two forms
    assert sorted(tuple(r) for r in found) == expected


def test_no_rows(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abÿ", min_size=1, max_size=7), min_size=1, max_size=80))
def test_index_finds_all_and_only_near_words(words):
    words = sorted(words)
    left, right = spelling.near_pairs(words)
    assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == [
        (i, k) for i, a in enumerate(words) for k, b in enumerate(words) if near(a, b)
    ]


def test_groups_are_cut_until_small_or_one_letter_apart(spark):
    rng = random.Random(2)
    words = list({"prefix" + "".join(rng.choices("abcdefgh", k=4)) for _ in range(1500)})
    rows = spelling.groups(spark.createDataFrame([(w, 3) for w in words], "word string, n long"), Workspace(spark, "t"), 30)
    sizes = Counter(r.key for r in rows.collect())
    assert max(sizes.values()) <= 64
    found = {(r.word, r.near) for r in spelling.near_words(
        spark.createDataFrame([(w, 3) for w in words], "word string, n long"), Workspace(spark, "t"), 30, 64
    ).collect()}
    assert found == {(a, b) for a in words for b in words if near(a, b)}
