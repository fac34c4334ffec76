"""Counts and collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from rentpulse.llm import word_graph

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_TO_Z)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][" ".join(words[i : i + k])] += 1
    return counts


def plain_collocations(rows, least, top=2000):
    out = []
    for lang, f in plain_counts(rows).items():
        n = sum(c for p, c in f.items() if " " not in p)
        found = []
        candidates = {p: c for p, c in f.items() if " " in p and c >= least}
        for phrase, a in candidates.items():
            if any(f" {phrase} " in f" {q} " and q != phrase and 100 * c >= 80 * a for q, c in candidates.items()):
                continue
            w = phrase.split(" ")
            cuts = [(f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w))]
            score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
            found.append((-score, -a, phrase.encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def made_rows(n=300):
    rng = random.Random(3)
    words = [*"abcdefgh", "Über", "x\x00y", "ÉA", "é b", "1%", "-"]
    line = "the Quick brown\tfox  jumps over"
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ". ", " \r\x0b"]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice([text, text, text + line, line, "", None, "a " * 60, ".,;\n"]), rng.choice(["en", "en", "en\tx", None])))
    return rows


@pytest.mark.parametrize(("heavy_share", "bits"), [(1 / 2000, 1 << 24), (1 / 10, 1 << 15), (1.0, 1 << 15), (1 / 10, 8)])
def test_counts(spark, heavy_share, bits, monkeypatch):
    """Whatever words count as heavy, and however many rare ones the bit maps let through."""
    monkeypatch.setattr(word_graph, "HEAVY_SHARE", heavy_share)
    monkeypatch.setattr(word_graph, "MAP_BITS", bits)
    monkeypatch.setattr(word_graph, "PATHS_AT_ONCE", 50)
    monkeypatch.setattr(word_graph, "BYTES_AT_ONCE", 500)
    rows = made_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    phrases, totals = word_graph.phrase_counts(docs, 5)
    plain = plain_counts(rows)
    wanted = {(lang, p): c for lang, f in plain.items() for p, c in f.items() if c >= 5}
    assert {(r.lang, r.phrase): r.f for r in phrases.collect()} == wanted
    assert {r.lang: r.n for r in totals.collect()} == {lang: sum(c for p, c in f.items() if " " not in p) for lang, f in plain.items()}


@pytest.mark.parametrize(("least", "top"), [(3, 2000), (10, 7)])
def test_collocations(spark, least, top):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert sorted(map(tuple, word_graph.collocations(docs, least, top).collect())) == plain_collocations(rows, least, top)


def test_paths_travel_packed(spark, monkeypatch):
    """Whatever the number of paths, a worker sends a row per share and language each time it packs; counts stay."""
    monkeypatch.setattr(word_graph, "WORDS_PER_SHARE", 500)
    rows = made_rows(2000)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(1)
    full = word_graph.BitMap(np.full(1 << 10, 255, np.uint8))
    named = docs.selectExpr("coalesce(lang, 'und') AS lang", "text").filter("text IS NOT NULL")
    sent = word_graph.weighted_paths(named, full, full, full, np.empty(0, np.uint64), 8)
    assert sent.count() <= 3 * 8
    for hold in (1 << 24, 2000):
        monkeypatch.setattr(word_graph, "PACKED_AT_ONCE", hold)
        monkeypatch.setattr(word_graph, "PATHS_AT_ONCE", 60_000 if hold > 2000 else 100)
        phrases, _ = word_graph.phrase_counts(docs, 5)
        wanted = {(lang, p): c for lang, f in plain_counts(rows).items() for p, c in f.items() if c >= 5}
        assert {(r.lang, r.phrase): r.f for r in phrases.collect()} == wanted


def test_words_beyond_a_count_rank_last(spark, monkeypatch):
    """Whatever their share; the counts stay."""
    rows = made_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    wanted = {(lang, p): c for lang, f in plain_counts(rows).items() for p, c in f.items() if c >= 5}
    monkeypatch.setattr(word_graph, "HEAVY_SHARE", 1.0)
    seen, paths = [], word_graph.weighted_paths
    monkeypatch.setattr(word_graph, "weighted_paths", lambda *a: seen.append(len(a[4])) or paths(*a))
    for most in (1 << 18, 20):
        monkeypatch.setattr(word_graph, "HEAVY_COUNT", most)
        phrases, _ = word_graph.phrase_counts(docs, 5)
        assert {(r.lang, r.phrase): r.f for r in phrases.collect()} == wanted
    assert seen[0] == 0 and seen[1] > 5


def test_scores_are_exact(spark):
    """Beyond 64 bits, where doubles round."""
    a, l, r = 9 * 10**15 + 1, 10**16 + 3, 10**16 + 7
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    got = row.selectExpr("CAST(a AS decimal(20, 0)) * 2000000 div (CAST(l AS decimal(20, 0)) + r) AS score").first().score
    assert got == 2_000_000 * a // (l + r)


def test_awkward_rows(awkward, nothing):
    assert word_graph.collocations(nothing).count() == 0
    rows = [(r.text, r.lang) for r in awkward.collect() if r.doc_id != 5]
    some = awkward.filter("doc_id IS NULL OR doc_id != 5")
    assert sorted(map(tuple, word_graph.collocations(some, 2).collect())) == plain_collocations(rows, 2)
    best = word_graph.collocations(awkward).filter("lang = 'en' AND rank = 1").first()
    assert best.n > 20_000 * 15 and best.a >= 20_000


def test_query_matches_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    got = entry.queries()["op11_word_graph"](spark, sf_dir)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cursor = connection.execute(entry.oracle_sql()["op11_word_graph"])
    assert [d[0] for d in cursor.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())
