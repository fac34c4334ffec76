"""Neighbour search and near-duplicate embeddings against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentpulse.llm import cap_filters, prefix_forest, queries

VECTORS = "vec_id long, embedding array<float>, label int, score double, v long, width int"


@pytest.fixture(scope="module")
def awkward_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((3, 8))
    rows = [(i, (base[i % 3] + 0.01 * rng.standard_normal(8)).tolist()) for i in range(30)]
    rows += [(100, None), (101, [0.0] * 8), (102, [float("nan")] * 8), (103, [1.0, None] + [1.0] * 6), (104, [float("inf")] + [0.0] * 7)]
    rows += [(105, []), (106, [1.0, 2.0]), (107, [2.0, 4.0]), (None, base[0].tolist()), (0, rows[0][1])]
    rows += [(200, [3e38] * 8), (201, [1e-30] * 8)]
    return spark.createDataFrame([(*r, 1, 0.5, 1, 1) for r in rows], VECTORS)


def load(documents_dir, spark):
    rows = spark.read.parquet(f"{documents_dir}/embeddings.parquet").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def test_recall_of_the_forest(spark, sf_dir):
    ids, rows = load(sf_dir, spark)
    got = queries.all_queries()["op8_prefix_forest"](spark, sf_dir).collect()
    assert {r.query_id for r in got} == {i for i in ids if i % 20 == 0}
    hits = 0
    for q in {r.query_id for r in got}:
        found = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        exact = (rows * rows[ids == q]).sum(axis=1)
        assert all(f[2] == exact[ids == f[1]][0] for f in found)
        exact[ids == q] = -np.inf
        hits += len({f[1] for f in found} & set(ids[np.lexsort((ids, -exact))[:20]].tolist()))
    assert hits >= 0.9 * len(got)


def test_runs_are_prefix_matches():
    rows = np.random.default_rng(6).standard_normal((200, 16))
    forest = prefix_forest.Forest(rows, trees=5, bits=10)
    low, high = forest.runs(rows[:20], 40)
    assert ((high - low).sum(axis=1) >= 40).all()
    for q in range(20):
        assert q in forest.candidates(low[q], high[q])
    assert forest.candidates(*(x[0] for x in forest.runs(rows[:1], 5 * 200))).size == 200


def test_blocks_change_no_answer_when_all_rows_are_candidates(spark, sf_dir, monkeypatch):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = prefix_forest.nearest(vectors, F.col("vec_id") % 20 == 0, 5, reach=1000.0).collect()
    monkeypatch.setattr(prefix_forest, "BLOCK_ROWS", 60)
    monkeypatch.setattr(prefix_forest, "QUERY_ROWS", 7)
    cut = prefix_forest.nearest(vectors, F.col("vec_id") % 20 == 0, 5, reach=1000.0).collect()
    key = lambda r: (r.query_id, r["rank"])
    assert [(*key(r), r.vec_id) for r in sorted(cut, key=key)] == [(*key(r), r.vec_id) for r in sorted(whole, key=key)]


def forest_recall(rows, asked, k=20):
    """Share of each asked row's k best inner products that one block finds, and the fewest answers of a query."""
    ids = np.arange(len(rows))
    got = prefix_forest.block_neighbours(rows, ids, rows[asked], asked, k, prefix_forest.REACH)
    hits, answers = 0, []
    for place, q in enumerate(asked):
        exact = rows @ rows[q]
        exact[q] = -np.inf
        scores = [score for at, _, score in got if at == place]
        hits += sum(score >= np.sort(exact)[-k] - 1e-9 for score in scores)
        answers.append(len(scores))
    return hits / (k * len(asked)), min(answers)


@pytest.mark.parametrize(("count", "copies"), [(500, 9), (500, 20), (2000, 5), (2000, 14)])
def test_copies_leave_room_for_other_neighbours(count, copies):
    rows = np.random.default_rng(11).standard_normal((count, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    asked = np.arange(12) * copies
    for first in asked:
        rows[first : first + copies] = rows[first]
    recall, answers = forest_recall(rows, asked)
    assert recall >= 0.9 and answers == 20


@pytest.mark.parametrize("spread", [0.3, 0.6, 1.0])
def test_recall_with_unequal_lengths(spread):
    rng = np.random.default_rng(12)
    rows = rng.standard_normal((8000, 64))
    rows *= np.exp(spread * rng.standard_normal((8000, 1))) / np.linalg.norm(rows, axis=1, keepdims=True)
    recall, answers = forest_recall(rows, np.arange(0, 8000, 200))
    assert recall >= 0.9 and answers == 20


def test_awkward_searches(awkward_vectors):
    got = prefix_forest.nearest(awkward_vectors, F.lit(True), 3).collect()
    ids = {r.query_id for r in got}
    assert not ids & {100, 101, 102, 103, 104, 105, None} and {0, 29, 106, 107} <= ids
    assert [r.vec_id for r in got if r.query_id == 106] == [107]  # only its own length
    assert all(r.query_id != r.vec_id for r in got)
    assert prefix_forest.nearest(awkward_vectors.filter("vec_id > 999"), F.lit(True)).count() == 0


def all_pairs(ids, rows, least):
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = (unit @ unit.T >= least) & (ids[:, None] != ids[None, :])
    label = ids.copy()
    for _ in ids:
        label = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1))
    return near.sum(axis=1), label


def clusters(spread):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((12, 64))
    rows = np.concatenate([c + spread * rng.standard_normal((n, 64)) for c, n in zip(centre, range(1, 80, 6), strict=False)])
    return np.arange(len(rows)) * 3 + 1, rows


@pytest.mark.parametrize("block_rows", [1500, 10])
def test_links_against_all_pairs(spark, monkeypatch, block_rows):
    """Cosines of the clusters' pairs are spread around 0.93; with 10 rows a block, filters are cut."""
    monkeypatch.setattr(cap_filters, "BLOCK_ROWS", block_rows)
    ids, rows = clusters(0.27)
    df = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, rows, strict=True)], "vec_id long, embedding array<double>")
    links, label = all_pairs(ids, rows, 0.9)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cap_filters.near_duplicates(df).collect()}
    assert got == {int(i): (int(n), int(c), i == c) for i, n, c in zip(ids, links, label, strict=True)}
    assert 0 < links.sum() and len(set(label.tolist())) < len(ids)


def test_decoded_filters_are_the_best():
    code = cap_filters.ProductCode(16, 12, 0)
    rows = np.random.default_rng(9).standard_normal((5, 16))
    turned = rows @ code.rotation
    scores = [turned[:, part] @ book.T for part, book in zip(code.parts, code.books, strict=True)]
    total = (scores[0][:, :, None, None] + scores[1][:, None, :, None] + scores[2][:, None, None, :]).reshape(5, -1)
    assert np.array_equal(np.sort(code.decode(rows, 16)), np.sort(np.argsort(-total, axis=1)[:, :16]))


@pytest.mark.parametrize("count", [50_000, 10_000_000, 1_000_000_000])
def test_pairs_meet_as_surely_in_a_large_table(count):
    """Pairs at a cosine of 0.9, coded as in a table of so many rows."""
    rng = np.random.default_rng(10)
    words = cap_filters.words_for(count)
    left, right = rng.standard_normal((2, 600, 64))
    left = left / np.linalg.norm(left, axis=1, keepdims=True)
    right -= (right * left).sum(axis=1, keepdims=True) * left
    right = 0.9 * left + np.sqrt(1 - 0.9**2) * right / np.linalg.norm(right, axis=1, keepdims=True)
    met = np.zeros(len(left), bool)
    for number in range(cap_filters.CODES):
        code = cap_filters.ProductCode(64, words, number)
        a, b = (code.decode(rows, cap_filters.lists_for(words, 64)) for rows in (left, right))
        met |= [bool(np.intersect1d(x, y).size) for x, y in zip(a, b, strict=True)]
    assert (~met).sum() <= 1


def test_awkward_links(awkward_vectors):
    rows = cap_filters.near_duplicates(awkward_vectors).collect()
    got = {r.vec_id: r for r in rows}
    assert len(rows) == awkward_vectors.select("vec_id", "embedding").distinct().count()
    for i in (100, 101, 102, 103, 104, 105):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    assert [got[i].component_id for i in (3, 4, 5)] == [0, 1, 2] and got[3].n_links == 9
    assert got[107].component_id == 106 and got[201].component_id == 200
    assert cap_filters.near_duplicates(awkward_vectors.filter("vec_id > 999")).count() == 0
