"""Dense groups of many families: links that no hub meets."""

from __future__ import annotations

import random

from ledgerwright.llm import near_dedup
from ledgerwright.llm import components as stars
from ledgerwright.llm import hubs
from ledgerwright.llm.hubs import hub_components
from ledgerwright.llm.shared import Workspace
from tests.llm.test_operators import prose, roots


def alike(x, y):
    return 100 * len(x & y) >= 80 * len(x | y)


def test_cells_of_many_families_are_completed(spark):
    """One cell of 240 families, of which a round's hubs meet eight, beside one that is barren."""
    rng = random.Random(5)
    sets = {}
    for family in range(240):
        own = [10_000 * (family + 1) + k for k in range(30)]
        for member in range(4):
            sets[4 * family + member] = {*range(60), *own, 10_000_000 + 4 * family + member}
    for k in range(100):
        sets[5000 + k] = {rng.getrandbits(40) for _ in range(40)}
    frame = spark.createDataFrame([(n, 0, sorted(s)) for n, s in sets.items()], "node long, key int, pieces array<long>")
    dense = spark.createDataFrame([(int(n >= 5000), n) for n in sets], "cell long, node long")
    none = spark.createDataFrame([], "a long, b long")

    def exact(pairs):
        kept = [(r.a, r.b) for r in pairs.collect() if alike(sets[r.a], sets[r.b])]
        return spark.createDataFrame(kept, "a long, b long")

    space = Workspace(spark, "dense")
    found, _ = hub_components(
        space, dense, none, none, exact, exact, lambda nodes: frame.join(nodes, "node", "left_semi"), 80
    )
    assert {r.node: r.component for r in found.collect()} == {n: n // 4 * 4 for n in range(960)}


def test_near_duplicates_of_many_families(spark):
    """Thirty families of twenty texts on one template, compared with brute force."""
    rng = random.Random(11)
    template = prose(rng, 120).split()
    texts = []
    for _ in range(30):
        family = list(template)
        family[58:70] = prose(rng, 12).split()
        for _ in range(20):
            text = list(family)
            text[rng.randrange(4, 56)] = prose(rng, 1)
            text[rng.randrange(72, 116)] = prose(rng, 1)
            texts.append(" ".join(text))
    sets = [{tuple(t.split()[k : k + 3]) for k in range(118)} for t in texts]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if alike(sets[a], sets[b])]
    want = roots(range(len(texts)), links)
    assert len(set(want.values())) == 30
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_dedup.near_duplicates(frame, 3).collect()
    assert {r.doc_id: r.component_id for r in rows} == want


def test_an_id_with_several_texts_is_one_document(spark):
    """Its texts belong together, whatever they are linked with."""
    x, y, z = (" ".join(f"{c}{k}" for k in range(30)) for c in "xyz")
    rows = [(1, x), (5, x), (5, y), (7, y), (7, z), (9, z), (20, x + " more"), (30, "one of its own"), (30, None)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [
        (1, 1), (5, 1), (5, 1), (7, 1), (7, 1), (9, 1), (20, 1), (30, 30), (30, 30)
    ]
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_a_pair_meets_about_once(spark):
    """Sets that share most of their prefixes, where each shared piece of a prefix once gave the pair again."""
    rng = random.Random(3)
    sets = {}
    for n in range(60):
        sets[n] = sorted({*rng.sample(range(140), 130), *range(1000 + 5 * n, 1005 + 5 * n)})
    frame = spark.createDataFrame([(n, 0, s) for n, s in sets.items()], "node long, key int, pieces array<long>")
    held = hubs._prefixes(Workspace(spark, "dense"), frame, 80)
    held = held.selectExpr("*", "node AS component", "false AS main")
    met = [(r.a, r.b) for r in hubs._met(held, 80).collect()]
    links = {(a, b) for a in sets for b in sets if a > b and alike(set(sets[a]), set(sets[b]))}
    assert len(links) > 1000 and links <= set(met)
    assert len(met) < 1.5 * len(set(met))


def test_sets_of_rare_pieces_only_have_no_prefix(spark):
    """Where so few pieces occur elsewhere that a set is linked with none, there is nothing to take."""
    sets = {n: [*range(20), *range(1000 * n, 1000 * n + n)] for n in range(1, 40)} | {50: list(range(90_000, 90_100)), 51: [90_000]}
    rows = [(n, 0, s) for n, s in sets.items()]
    frame = spark.createDataFrame(rows, "node long, key int, pieces array<long>").repartition(3)
    found = hubs._prefixes(Workspace(spark, "dense"), frame, 80).collect()
    want = {n: max(0, len(s) - (80 * len(s) + 99) // 100 + 1 - (len(s) - 20)) for n, s in sets.items() if n < 50} | {50: 0, 51: 1}
    assert want[39] == 0 and want[1] > 0
    assert {n: sum(r.node == n for r in found) for n in sets} == want


def test_steps_of_components_leave_few_files(spark, tmp_path):
    """A few links give a few files whatever the number of shuffle partitions, and the steps are gone at the end."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    space = Workspace(spark, "few")
    space.path = str(tmp_path / "few")
    links = spark.createDataFrame([(k + 1, k) for k in range(50)] + [(200, 100)], "a long, b long")
    try:
        for name, value in zip(names, ("60", "false"), strict=True):
            spark.conf.set(name, value)
        found = stars.components(space, links)
        assert {r.node: r.component for r in found.collect()} == {k: 0 for k in range(51)} | {200: 100, 100: 100}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(list((tmp_path / "few").rglob("*.parquet"))) < 10


def test_small_cells_have_one_round(spark):
    """Cells of many families, complete after one round of hubs and the prefix join."""
    sets = {}
    for family in range(40):
        own = [10_000 * (family + 1) + k for k in range(30)]
        for member in range(4):
            sets[4 * family + member] = {*range(60), *own, 10_000_000 + 4 * family + member}
    frame = spark.createDataFrame([(n, 0, sorted(s)) for n, s in sets.items()], "node long, key int, pieces array<long>")
    dense = spark.createDataFrame([(0, n) for n in sets], "cell long, node long")
    none = spark.createDataFrame([], "a long, b long")
    rounds = []

    def exact(pairs):
        rounds.append(pairs)
        kept = [(r.a, r.b) for r in pairs.collect() if alike(sets[r.a], sets[r.b])]
        return spark.createDataFrame(kept, "a long, b long")

    space = Workspace(spark, "dense")
    pieces = lambda nodes: frame.join(nodes, "node", "left_semi")
    found, _ = hub_components(space, dense, none, none, exact, exact, pieces, 80, hubs=1, small=200)
    assert {r.node: r.component for r in found.collect()} == {n: n // 4 * 4 for n in range(160)}
    assert len(rounds) == 2
