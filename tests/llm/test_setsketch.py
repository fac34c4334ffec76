"""Sketches, estimates and components against full sets."""

import re

import numpy as np
import pytest

from rentpulse.llm import setsketch
from rentpulse.llm.components import components


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(words) < 2:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(words, words[1:], strict=False))


def plain_components(sets):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "A b", "a B\x0bc\x1cd", "É é É é", "x " * 50])
def test_shingle_sets(text):
    assert len(setsketch.shingle_set(text, 2)) == len(plain_set(text))


def test_registers_merge():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (300, 5000))
    union = setsketch.registers(np.union1d(a, b))
    assert np.array_equal(setsketch.merged(setsketch.registers(a), setsketch.registers(b)), union)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8, 0.95])
def test_estimates(share):
    rng = np.random.default_rng(int(share * 100))
    got = []
    for _ in range(30):
        pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        cut = int(500 * (1 - share))  # a and b share all but ``cut`` elements of either
        a, b = pool[:500], pool[cut : 500 + cut]
        x, y = setsketch.registers(a), setsketch.registers(b)
        true = (500 - cut) / (500 + cut)
        e = setsketch.estimate(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([500.0]), np.array([500.0]))
        got.append(e[0] - true)
    assert abs(np.mean(got)) < 0.03


def test_documents_against_all_pairs(documents, texts):
    sets = {d: plain_set(t) for d, t in texts.items()}
    expected = plain_components(sets)
    got = result(setsketch.near_duplicates(documents, words=2))
    assert got == {d: (len(s), expected[d], expected[d] == d) for d, s in sets.items()}
    assert sum(not kept for _, _, kept in got.values()) > 5


def test_chains_and_large_groups_in_blocks(spark, monkeypatch):
    """Neighbours of a chain are linked, its ends are not; groups are cut into several blocks."""
    monkeypatch.setattr(setsketch, "BLOCK_ROWS", 8)
    words = [f"w{i}" for i in range(400)]
    rows = [(100 + i, " ".join(words[8 * i : 8 * i + 200])) for i in range(20)]
    rows += [(200 + i, " ".join([*words[:150], f"own{i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_components({d: plain_set(t) for d, t in rows})
    assert {d: c for d, (_, c, _) in result(setsketch.near_duplicates(df, words=2)).items()} == expected
    assert len(set(expected.values())) == 2


def test_awkward_rows(awkward):
    rows = setsketch.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[6].component_id == by_id[7].component_id == 4 and not by_id[7].kept
    assert by_id[None].component_id is None and by_id[None].kept
    assert [r.kept for r in rows if r.doc_id == 8] == [True, True]


def test_no_rows(nothing):
    assert setsketch.near_duplicates(nothing).count() == 0


def test_components_of_awkward_graphs(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 9), (None, 3), (20, 30), (30, 20), (20, 30), (7, None)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 20: 20, 30: 20}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_likely_pairs_that_do_not_hold(spark, monkeypatch):
    """A large group at a similarity below the threshold, among it a few links that only full sets can tell."""
    monkeypatch.setattr(setsketch, "BLOCK_ROWS", 16)
    common = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(common + [f"o{i}x{k}" for k in range(28)])) for i in range(90)]
    rows += [(500 + i, " ".join(common + [f"o{i}x{k}" for k in range(23)] + [f"p{i}x{k}" for k in range(5)])) for i in range(0, 90, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_components({d: plain_set(t) for d, t in rows})
    assert {d: c for d, (_, c, _) in result(setsketch.near_duplicates(df, words=2)).items()} == expected
    assert len(set(expected.values())) == 90
