"""The pipeline stage by stage, each against its own rule, and the queries against SQL."""

import os

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def stages(spark, documents, sf_dir):
    """Every stage's rows, the documents first."""
    out = [documents]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_dir).cache())
    return [df.collect() for df in out]


def test_stage_order_and_columns(stages, documents):
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "suffix_dedup", "source_mix", "byte_bpe"]
    for rows in stages[1:5]:
        assert rows and rows[0].__fields__ == documents.columns
    assert stages[5][0].__fields__ == ["doc_id", "ids", "n_tokens"]


def test_decisions_take_effect(stages):
    start, spoken, single, cut, mixed, coded = stages
    assert {r.doc_id for r in spoken} <= {r.doc_id for r in start}
    assert all(any(c.isalpha() for c in r.text) for r in spoken)
    assert len(single) < len(spoken) and len({r.doc_id for r in single}) == len(single)
    assert {r.doc_id for r in cut} == {r.doc_id for r in single}
    assert sum(len(r.text) for r in cut) < sum(len(r.text) for r in single)
    assert all(r.n_chars == len(r.text) for r in cut)
    times = [sum(m.doc_id == r.doc_id for m in mixed) for r in cut]
    assert max(times) == 2
    size = {r.doc_id: len(r.text.split()) for r in cut}
    assert sum(size[r.doc_id] for r in mixed) == pytest.approx(1.5 * sum(size.values()), rel=0.1)
    assert len(coded) == len(mixed) and all(len(r.ids) == 4 * r.n_tokens for r in coded)


def test_stages_survive_awkward_rows(spark, awkward, nothing, sf_dir):
    for docs in (awkward, nothing):
        for _, stage in pipeline.STAGES[:4]:
            docs_out = stage(spark, docs, sf_dir)
            assert docs_out.columns == docs.columns
            docs = docs_out.cache()
        ids = [r.doc_id for r in docs.collect()]
        assert not set(ids) & {1, 2, 3, 7, 9}
        assert pipeline.STAGES[4][1](spark, docs, sf_dir).count() == len(ids)


def test_unlearned_scripts_go_and_real_documents_stay(spark, documents, sf_dir):
    """Made-up texts, long and short, in scripts without a training document, and words of random letters."""
    rng = np.random.default_rng(5)
    scripts = {"cyrillic": (0x430, 0x450), "greek": (0x3B1, 0x3CA), "hiragana": (0x3041, 0x3097), "cjk": (0x4E00, 0x9FFF), "random": (97, 123)}
    made = {}
    for name, (low, high) in scripts.items():
        for words in (200,) * 40 + (2,) * (0 if name == "random" else 40):
            text = " ".join("".join(map(chr, rng.integers(low, high, rng.integers(3, 9)))) for _ in range(words))
            made[10**9 + len(made)] = (name, text)
    rows = [(i, text, None, "a", len(text)) for i, (_, text) in made.items()]
    docs = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    left = {r.doc_id for r in pipeline.identify_language(spark, docs, sf_dir).collect()}
    assert {r.doc_id for r in documents.collect() if any(c.isalpha() for c in r.text)} <= left
    stayed = [made[i][0] for i in left if i in made]
    assert all(stayed.count(name) <= 3 for name in scripts)


def test_replacement_characters_of_the_input_stay(spark, documents):
    """Documents that share 300 bytes between characters of two bytes, which differ in the second or first one."""
    shared = "".join(f"word{i} " for i in range(45))
    texts = ["one \ufffd start é" + shared + "à end \ufffd one", "two start ĩ" + shared + "â other end", "three \ufffd"]
    docs = spark.createDataFrame([(i, text, "en", "a", len(text)) for i, text in enumerate(texts)], documents.schema)
    cut = {r.doc_id: r for r in pipeline.cut_repeats(spark, docs, "").collect()}
    assert cut[0].text == "one \ufffd start  end \ufffd one" and cut[1].text == "two start  other end"
    assert cut[2].text == "three \ufffd" and all(r.n_chars == len(r.text) for r in cut.values())


@pytest.mark.parametrize("name", ["op2_url_lists", "op3_source_mix", "op5_quote_links"])
def test_query_matches_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for file in os.listdir(sf_dir):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    df = entry.queries()[name](spark, sf_dir)
    expected = db.execute(f"SELECT {', '.join(df.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)


def test_every_operator_is_registered():
    assert [f"op{n}_" for n in range(1, 14)] == sorted({k.split("_")[0] + "_" for k in entry.queries() if k.startswith("op")}, key=lambda k: int(k[2:-1]))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("stage", [stage for _, stage in pipeline.STAGES])
def test_workers_get_batches_of_bounded_bytes(spark, documents, sf_dir, stage):
    """Long texts come in batches of fewer rows; what a worker holds does not follow the length of the texts."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    stage(spark, documents.limit(20), sf_dir)
    long = spark.range(0, 3000, 1, 1).selectExpr("repeat('some text ', 500) AS text")
    sizes = long.mapInPandas(lambda batches: (b.assign(n=len(b)).drop(columns="text") for b in batches), "n long")
    assert sizes.agg({"n": "max"}).first()[0] * 5000 <= pipeline.BATCH_BYTES + 5000
    rows = [r.n for r in sizes.collect()]
    assert len(rows) == 3000
