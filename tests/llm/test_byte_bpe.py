"""Encoding against the public library, and the round trip."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from rentpulse.llm import byte_bpe, queries

RANKS = byte_bpe.parse_ranks(byte_bpe.load_ranks(queries.RANKS))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def ids(packed):
    return list(memoryview(packed).cast("I")) if packed else []


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    encoder = test_any_text.encoder = getattr(test_any_text, "encoder", None) or byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    assert ids(encoder.encode([text])[0]) == plain.encode_ordinary(text)


def test_long_and_odd_pieces(reference, encoder):
    rng = random.Random(3)
    odd = ["", "a", "aa" * 3000, " " * 2000 + "x", "ab" * 700, "日本語テスト" * 30, "<|endoftext|>", "".join(rng.choices("abcdefgh", k=2500))]
    assert [ids(x) for x in encoder.encode(odd)] == [reference.encode_ordinary(t) for t in odd]


def test_rows_and_single_trees_agree(encoder):
    rng = random.Random(5)
    pieces = {bytes(rng.choices(b"the ndaio", k=rng.randint(2, 32))) for _ in range(500)}
    pieces = [p for p in pieces if p not in RANKS]
    packed = byte_bpe.merge_rows(pieces, encoder.pairs, 32)
    assert [ids(x) for x in packed] == [byte_bpe.merge(p, RANKS) for p in pieces]


def test_forgetting_pieces_changes_nothing(texts, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 50)
    monkeypatch.setattr(byte_bpe, "TEXT_AT_ONCE", 5000)
    some = list(texts.values())[:30]
    got = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN).encode(some)
    assert [ids(x) for x in got] == [reference.encode_ordinary(t) for t in some]


def test_query(spark, sf_dir, texts, reference):
    rows = queries.all_queries()["op6_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in expected)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward_rows(spark, awkward, nothing):
    codec = byte_bpe.codec(spark, queries.RANKS, public_tokenizers.PATTERN)
    coded = awkward.withColumn("ids", codec.encode("text")).withColumn("back", codec.decode("ids"))
    rows = coded.select("text", "ids", "back", byte_bpe.token_count(coded["ids"]).alias("tokens")).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert bytes(r.back) == (r.text or "").encode() and r.tokens == len(r.ids) // 4
    assert nothing.withColumn("ids", codec.encode("text")).count() == 0
