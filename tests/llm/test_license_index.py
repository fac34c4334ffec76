"""Phrases against a search of every place, notices in altered forms."""

import random
import re

import pytest

from rentpulse.llm import license_index, queries

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))


def plain_base(words):
    """(first word, label) of every place of a phrase."""
    out = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return sorted(out)


def found(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = license_index.find_licenses(rows).collect()
    return [r.licenses for r in sorted(got, key=lambda r: r.doc_id)]


def base(places):
    return sorted((p.start, p.label) for p in places if p.exact)


def test_places_of_phrases(spark):
    rng = random.Random(4)
    words = ["under", "the", "MIT", "License", "apache", "license,", "version", "2", "CC", "BY-NC", "by", "nc", "é", "the mit"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "--", "\x00"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["CC BY NC " * 50, "cc cc by nc by nc", "Under THE mit-LICENSE", "under the mit licenseé", None, ""]
    for text, got in zip(texts, found(spark, texts), strict=True):
        assert got.n_words == len(plain_words(text))
        assert base(got.places) == plain_base(plain_words(text))


@pytest.mark.parametrize("notice", license_index.NOTICES, ids=lambda n: n.text[:30])
def test_notices(spark, notice):
    words = notice.text.split()
    far = "lorem ipsum dolor " * 30
    texts = [
        far + notice.text.upper() + " " + far,
        "# " + "\n# ".join(words),  # another layout
        far + far,
        " ".join(reversed(words)),  # the same words, no key phrase
    ]
    got = [{p.label for p in r.places} for r in found(spark, texts)]
    assert notice.label in got[0] and notice.label in got[1]
    assert not got[2] and notice.label not in got[3]


def test_altered_notices(spark):
    """Words put in, left out or changed outside of the key phrases are borne up to a share."""
    mit = next(n for n in license_index.NOTICES if n.label == "mit")
    texts = [
        mit.text.replace("any person obtaining", "any one person who is obtaining").replace("associated", "related"),
        mit.text.replace("free of charge", "at no cost"),  # a key phrase is gone
        mit.text[: len(mit.text) // 2],
        mit.text + ". " + mit.text,
    ]
    got = found(spark, texts)
    assert [sorted({p.label for p in r.places}) for r in got] == [["mit"], [], [], ["mit"]]
    assert 0.8 <= got[0].places[0].score < 1 and len(got[3].places) == 2


def test_weights_count_all_documents(spark):
    rows = spark.createDataFrame([("the mit",), ("the the",), (None,)], "text string").repartition(3)
    weights = license_index.word_weights(rows, license_index.PHRASES)
    assert weights[b"the"] < weights[b"mit"] < weights[b"license"]


def test_key_phrases_are_part_of_their_notice():
    with pytest.raises(ValueError, match="not part"):
        license_index.LicenseIndex([license_index.Notice("x", "a b c", ("a c",))], {b"a": 1.0, b"b": 1.0, b"c": 1.0})


def test_awkward_rows(awkward, nothing):
    got = license_index.find_licenses(awkward)
    assert got.columns == [*awkward.columns, "licenses"]
    for r in got.collect():
        assert r.licenses.n_words == len(plain_words(r.text)) and not r.licenses.places
    assert license_index.find_licenses(nothing).count() == 0


def test_query(spark, sf_dir, texts):
    got = {r.doc_id: r for r in queries.all_queries()["op13_license_index"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        words, r = plain_words(text), got[doc_id]
        wanted = plain_base(words)
        assert (r.n_words, r.n_base) == (len(words), len(wanted))
        assert (r.first_word, r.last_word) == ((wanted[0][0], wanted[-1][0]) if wanted else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in wanted}))
        assert {label for _, label in wanted} <= set(r.labels.split(","))
        assert r.score == 0 if not r.labels else 0.8 <= r.score <= 1
        assert ("GNU General Public License, version 3" in text) == ("gpl-3" in r.labels)
