"""Every operator against brute force on small tables with the awkward cases in them."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerwright.llm import (
    components,
    decontaminate,
    fingerprint,
    fm_index,
    html_text,
    language,
    line_dedup,
    near_dedup,
    packing,
    substring_dedup,
    toxicity,
    url_filter,
    words,
)
from ledgerwright.llm.shared import Workspace

SYLLABLES = "ka lo mi ne ru sa ti vo".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, cell long, component string"


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def documents():
    """Copies, near copies, shared passages, nulls, empty and very long texts, and clashing columns."""
    rng = random.Random(7)
    passage, base = prose(rng, 40), prose(rng, 120)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    texts += [base] * 5 + [base.replace(" ", "\n", 3)] * 2
    for k in range(40):
        changed = base.split()
        changed[rng.randrange(120)] = f"edit{k}"
        texts.append(" ".join(changed))
    texts += [prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 20) for _ in range(8)]
    texts += ["", " ", "\n\n", "one", "one two", "ONE two", "a " * 3000, prose(rng, 9000), None, "x" * 5000, "éà 漢字   ok"]
    rows = [(k, t, "en", k % 3, "x") for k, t in enumerate(texts)]
    return rows + [rows[3], (None, "no id here", None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, size, lower):
    text = text or ""
    if lower:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = WORD.findall(text)
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_words_are_hashed_alike_in_every_piece(monkeypatch):
    texts = pa.array([t for _, t, *_ in documents()])
    whole, at = words.hashed(texts, lower=True)
    monkeypatch.setattr(words, "_PIECE", 64)
    again, at_again = words.hashed(texts, lower=True)
    assert np.array_equal(whole, again) and np.array_equal(at, at_again)
    marks, marks_at = words.hashed(texts.slice(2), blanks=words.PUNCTUATION)
    assert [j - i for i, j in zip(marks_at[:-1], marks_at[1:], strict=True)] == [
        len(re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", t or "")) for t in texts.slice(2).to_pylist()
    ]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(500, k) for k in range(501, 700)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components.components(Workspace(spark, "t"), frame).collect()}
    want = roots({n for link in links for n in link}, links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: want[n] for n in linked}


@pytest.mark.parametrize("size,percent,lower", [(3, 85, True), (5, 80, False)])
def test_near_duplicates(docs, size, percent, lower):
    rows = near_dedup.near_duplicates(docs, size, percent, lower).collect()
    sets = {i: shingle_set(t, size, lower) for i, t, *_ in documents() if i is not None}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = roots(sets, links)
    assert len(rows) == len(documents())
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_of_one_hub(spark):
    """Copies that are similar to their base only, in a region far beyond the window."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base)]
    for k in range(150):
        w = list(base)
        w[rng.randrange(2, 58)] = f"new{k}"
        texts.append(" ".join(w))
    frame = spark.createDataFrame([(1000 - k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(frame, 3, 85).collect()} == {850}


def line_set(line):
    return {line[k : k + 8] for k in range(max(1, len(line) - 7))}


def test_line_dedup(docs):
    rows = line_dedup.dedup_lines(docs)
    assert rows.columns == [*docs.columns, "__lines", "__removed"]
    given = {}
    for i, t, *_ in documents():
        given.setdefault((i, t), None)
    lines = sorted({x for _, t in given if t is not None for x in t.split("\n") if re.search(r"[^ \t\n\x0b\f\r]", x)})
    sets = {x: line_set(x) for x in lines}
    links = [(a, b) for a in lines for b in lines if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = roots(lines, links)
    seen, want = set(), {}
    for i, t in sorted(given, key=lambda x: (x[0] is not None, x[0] or 0)):
        kept = []
        for x in (t or "").split("\n"):
            if x in group:
                if group[x] in seen:
                    continue
                seen.add(group[x])
            kept.append(x)
        want[i, t] = None if t is None else "\n".join(kept)
    assert sorted((r.doc_id is None, r.doc_id or 0, str(r.text)) for r in rows.collect()) == sorted(
        (i is None, i or 0, str(want[i, t])) for i, t, *_ in documents()
    )


def test_substring_dedup(docs):
    first, want = {}, {}
    for i, t in sorted({(i, t) for i, t, *_ in documents() if i is not None}, key=lambda x: x[0]):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), i) < i:
                gone[k : k + 13] = [True] * 13
        want[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    rows = substring_dedup.dedup_substrings(docs).collect()
    assert len(rows) == len(documents())
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.text) == want[r.doc_id]
        else:
            assert r.n_removed == 0


def test_substring_dedup_deals_hot_keys_by_window(docs, monkeypatch):
    want = {(r.doc_id, r.n_removed, r.text) for r in substring_dedup.dedup_substrings(docs).collect()}
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    monkeypatch.setattr(substring_dedup, "SHARD", 50)
    assert {(r.doc_id, r.n_removed, r.text) for r in substring_dedup.dedup_substrings(docs).collect()} == want


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(2, 6), st.lists(st.integers(1, 5), min_size=1, max_size=30))
def test_fm_index_finds_every_window(symbols, depth, pattern):
    index = fm_index.FMIndex(np.array([*symbols, 0]), depth)
    text, pattern = [*symbols, 0], np.array(pattern)
    found = {}
    for _, offset, low, high in fm_index.matching(index, pattern, np.array([0]), np.array([len(pattern)])):
        for o, a, b in zip(offset, low, high, strict=True):
            found[int(o)] = sorted(index.order[a:b].tolist())
    for o in range(len(pattern) - depth + 1):
        places = [k for k in range(len(text) - depth + 1) if text[k : k + depth] == pattern[o : o + depth].tolist()]
        assert found.get(o, []) == places


def test_decontamination(spark):
    rng = random.Random(5)
    items = [(k, ". ".join(prose(rng, rng.randint(3, 90)).capitalize() for _ in range(2)) + ".") for k in range(30)]
    rows = [(k, prose(rng, rng.randint(0, 400)), k) for k in range(60)]
    want = set()
    for k in range(0, 60, 4):
        item = rng.randrange(30)
        cut = rng.randrange(len(rows[k][1]) + 1)
        rows[k] = (k, rows[k][1][:cut] + " " + items[item][1].upper().replace(" ", "\n") + " " + rows[k][1][cut:], k)
        want.add((k, item))
    docs = spark.createDataFrame([*rows, rows[0], (None, None, 1), (99, "", 1)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([*items, items[0], (50, None), (51, "")], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= want
    assert all(r.question_overlap >= 0.8 and r.answer_overlap >= 0.8 for r in found)
    assert len({(r.doc_id, r.item_id) for r in found} - want) <= 0.1 * len(want)
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {r.doc_id for r in found} | {None, 99}


def test_decontamination_in_shards(spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, prose(rng, 30)) for k in range(20)]
    docs = spark.createDataFrame([(k, prose(rng, 50) + " " + items[k][1]) for k in range(20)], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 100)
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(k, k) for k in range(20)}


def test_language(spark):
    rng = random.Random(2)
    stock = {"aa": "ka lo mi".split(), "bb": "ré tü zö".split()}
    make = lambda lang, n: " ".join("".join(rng.choices(stock[lang], k=3)) for _ in range(n))
    rows = [(k, make(lang, rng.randint(5, 60)), lang, "x") for k in range(120) for lang in [rng.choice(["aa", "bb"])]]
    odd = [(500, None, "aa", None), (501, "", "aa", None), (502, "12 34 ?!", "bb", None), (None, make("bb", 9), None, None)]
    docs = spark.createDataFrame([*rows, rows[0], *odd], "doc_id long, text string, lang string, score string")
    found = language.predict(docs).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows) + 5
    assert all(by[i].lang_pred == lang and 0.5 < by[i].score <= 1 for i, _, lang, _ in rows)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (500, 501, 502)) and by[None].lang_pred == "bb"
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    # Unseen words go by their n-grams.
    model = language.train(docs)
    assert language.Identifier(model).identify("kalokamilolo")[0] == "aa"
    assert {r.lang_pred for r in language.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(spark):
    rng = random.Random(4)
    bad = ["grumblefink", "snorkelwort", "blatherskite"]

    def text(toxic):
        w = prose(rng, rng.randint(40, 160)).split()
        for _ in range(len(w) // 12 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        return " ".join(w)

    rows = [(k, text(k % 4 == 0)) for k in range(600)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(600)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    found = toxicity.predict(docs, labels).collect()
    assert len(found) == 603 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 600]
    assert np.mean([r.predicted for r in held if r.doc_id % 4 == 0]) > 0.9
    assert np.mean([r.predicted for r in held if r.doc_id % 4]) < 0.05
    none = toxicity.predict(docs, labels.limit(0)).collect()
    assert len(none) == 603 and {r.score for r in none} == {0.0}


SENTENCE = "the cat is on the mat and it is not in the house of the man who was here with the dog that he had"
LONG = f"<p>{SENTENCE}</p>"


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<script>a < b</script>", ""),
        ("<body><nav><a href=x>Home</a></nav><article><h1>Old &amp; new</h1><p>Short.<p>Two<br>lines</article><footer>c</footer>", "Old & new Short. Two lines"),
        ("<article><p>One <b>bo</b>ld</p><div class='comment-list'><p>Nice</p></div><aside>more</aside><p>End &lt;here&gt;</article>", "One bold End <here>"),
        ("<article><h1>Title</h1><form>Name <p>x</p></form><p>Cut off &am", "Title Cut off &am"),
        ("<div class=ad>buy</div><main><p>Text <!-- no --> here <a href=y>link</a> and more of it</main>", "Text here link and more of it"),
        (LONG + "<h2>Next</h2><p>Short." + LONG + "<p>Related:<p><a href=z>all links here</a>", f"{SENTENCE} Next Short. {SENTENCE}"),
    ],
)
def test_html(page, text):
    assert html_text.main_text(page) == text.strip()


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, None, "<article>é 漢</article>", "x"), (1, None, None, "y"), (None, "u", "a<b", "z")], "page_id long, url string, html string, text string")
    rows = html_text.extract(pages).collect()
    assert sorted((r.text, r.n_chars) for r in rows)[-1] == ("é 漢", 3) and len(rows) == 3
    assert html_text.main_text("<div " * 3000) == "" and len(html_text.main_text("<article>" + "<p>ab " * 20000)) == 59999


TOKENIZED = st.text(st.sampled_from("aBzé'ßÀ×÷1²½ªº.,!?-~ \t\n\x1c ́İſ<|endoftext|>漢🙂sdtm"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(TOKENIZED)
def test_chunks_give_the_tokenizers_ids(text):
    chunks = test_chunks_give_the_tokenizers_ids.__dict__.setdefault("chunks", packing.Chunks(packing.vocabulary()))
    want = chunks._tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(chunks.ids(text), "<u4").tolist() == want


def test_chunks_of_many_texts_are_looked_up_once():
    texts = pa.array(["left out", None, "", " a  Don't x\x1cy\u00a0z\r\n", "caf\u00e9 12 \u6f22 a", " <|endoftext|>a "] + ["a b"] * 50).slice(1)
    asked = []

    class Counted(packing.Chunks):
        def __getitem__(self, chunk):
            asked.append(chunk)
            return super().__getitem__(chunk)

    ids, bounds = Counted(packing.vocabulary()).all_ids(texts)
    assert len(asked) == len(set(asked)) < 20
    chunks = packing.Chunks(packing.vocabulary())
    for text, low, high in zip(texts.to_pylist(), bounds[:-1], bounds[1:], strict=True):
        assert ids[low:high].tobytes() == chunks.ids(text)


def test_packing(docs):
    rows = packing.pack(docs.select("doc_id", "text"), capacity=512).collect()
    chunks = packing.Chunks(packing.vocabulary())
    want = []
    for i, t, *_ in documents():
        ids = np.frombuffer(chunks.ids(t), "<u4").tolist() + [1]
        for k in range(0, len(ids), 512):
            part = np.array(ids[k : k + 512], "<u4")
            want.append((i, k // 512, k, len(part), zlib.crc32(part.tobytes())))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    inside = {}
    for r in rows:
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in inside.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 512
    rooms = []
    for n in sorted((r.length for r in rows), reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if not fits:
            rooms.append(512)
            fits = [len(rooms) - 1]
        rooms[min(fits, key=rooms.__getitem__)] -= n
    assert len(inside) <= len(rooms)


def fewest(sizes, capacity):
    """The least number of bins, by trying all."""
    best = [len(sizes)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for i, room in enumerate(bins):
            if room >= sizes[k] and room not in bins[:i]:
                place(k + 1, [*bins[:i], room - sizes[k], *bins[i + 1 :]])
        place(k + 1, [*bins, capacity - sizes[k]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_dominance_never_costs_a_sequence(sizes):
    sizes = sorted(sizes, reverse=True)
    counts = np.bincount(sizes, minlength=21).tolist()
    found, fixed = packing.patterns(counts)
    assert sorted(n for t, lengths in found for n in lengths * t) == sorted(sizes)
    assert all(sum(lengths) <= 20 for _, lengths in found)
    # Sequences before the first best-fit one are fixed by dominance; the rest must still be optimal beside them.
    if fixed == sum(t for t, _ in found):
        assert fixed == fewest(sizes, 20)


PIECES = re.compile(r"[^ \t\n\x0b\f\r]+(?:[ \t\x0b\f\r]+[^ \t\n\x0b\f\r]+){0,15}")


def test_fingerprints(docs):
    by_id = {}
    for i, t, *_ in documents():
        by_id.setdefault((i, t or ""), None)
    numbered = sorted((k for k in by_id if k[0] is not None), key=lambda x: -x[0])
    rows = fingerprint.fingerprints(docs).collect()
    assert len(rows) == len(documents())
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    pieces = lambda t: set(PIECES.findall(t))
    alike = lambda a, b: 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0
    for (i, t), (_, following) in zip(numbered[:-1], numbered[1:], strict=True):
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(alike(pieces(t), pieces(edited)))
        assert r.near_next == pytest.approx(alike(pieces(t), pieces(following)))
    texts = dict(numbered)
    for a in found:
        for b in found:
            if texts[a] == texts[b]:
                assert found[a].fingerprint == found[b].fingerprint


def test_url_filter(spark):
    rows = [
        (1, "http://User@A.Example.COM.:80/x/y?q", 5),
        (2, "http://a.example.com/x", 5),
        (3, "http://a.example.com/x", 15),
        (4, "https://example.com", 25),
        (5, "https://notexample.com/x/y", 25),
        (6, None, 5),
        (7, "/relative", 5),
        (8, "http://a.example.com/x", None),
        (2, "http://a.example.com/x", 5),
        (9, "http://" + "a." * 500 + "example.com/" + "x/" * 500, 12),
    ]
    entries = [
        ("block", "domain", "example.com", "add", 0),
        ("block", "domain", "example.com", "remove", 10),
        ("block", "domain", "example.com", "add", 10),
        ("block", "domain", "example.com", "add", 20),
        ("allow", "prefix", "a.example.com/x", "add", 3),
        ("allow", "prefix", "a.example.com/x", "remove", 30),
        ("block", "prefix", "a.example.com/x/y", "add", 5),
        ("block", "prefix", "a.example.com/x/y", "add", 5),
        ("block", None, "b", "add", 1),
        ("block", "domain", "com", "look", 1),
    ]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at long")
    lists = spark.createDataFrame(entries, "list_name string, kind string, pattern string, action string, at long")
    found = url_filter.judge(captures, lists).collect()
    got = sorted((r.page_id, r.kept, r.pattern) for r in found if r.page_id not in (6, 7, 8, 5, 9))
    assert got == [
        (1, False, "a.example.com/x/y"),
        (2, True, "a.example.com/x"),
        (2, True, "a.example.com/x"),
        (3, True, "a.example.com/x"),
        (4, False, "example.com"),
    ]
    assert all(r.kept and r.pattern is None for r in found if r.page_id in (5, 6, 7, 8, 9)) and len(found) == 10


@pytest.mark.parametrize("name", ["near", "lines", "substrings", "leaks", "language", "toxicity", "html", "packing", "prints", "urls"])
def test_empty_tables(spark, empty, name):
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    run = {
        "near": lambda: near_dedup.near_duplicates(empty),
        "lines": lambda: line_dedup.dedup_lines(empty),
        "substrings": lambda: substring_dedup.dedup_substrings(empty),
        "leaks": lambda: decontaminate.contaminated(empty, items).unionAll(decontaminate.contaminated(empty, items)),
        "language": lambda: language.predict(empty),
        "toxicity": lambda: toxicity.predict(empty, spark.createDataFrame([], "doc_id long, toxic int")),
        "html": lambda: html_text.extract(pages),
        "packing": lambda: packing.pack(empty),
        "prints": lambda: fingerprint.fingerprints(empty),
        "urls": lambda: url_filter.judge(url_filter.captures_of(pages), url_filter.entries_of(pages)),
    }
    assert run[name]().count() == 0
