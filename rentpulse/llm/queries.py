"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentpulse.llm import (
    byte_bpe,
    cap_filters,
    hidden_markov,
    language_id,
    license_index,
    prefix_forest,
    quote_links,
    setsketch,
    source_mix,
    square_catchers,
    suffix_dedup,
    url_lists,
    word_graph,
)
from rentpulse.llm.common import WORD, crc_remainder, read_table, whole_text

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the Python workers, as ``--py-files`` does, once per application."""
    if any(name.endswith("rentpulse_code.zip") for name in spark.sparkContext._python_includes):
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="rentpulse-code-"), "rentpulse_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)


def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "_cut.n_bytes", "_cut.n_removed", "_cut.n_spans", F.sha2("_cut.kept", 256).alias("kept_sha256"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date spread over a year, by their id."""
    return pages.select("page_id", "url", F.expr("date_add(date '2024-01-01', int(page_id * 7919 % 365))").alias("fetched_on"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries for the pages' hosts, parent domains and a path, on dates that follow from their names."""
    hosts = pages.select(url_lists.host(F.col("url")).alias("host")).filter("host != ''").distinct()
    number = lambda c: F.conv(F.substring(F.md5(c.cast("binary")), 1, 6), 16, 10).cast("int")
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    named = hosts.withColumns({"x": number(F.col("host")), "parent": parent, "y": number(parent)})
    entry = "struct({} AS pattern, date_add(date '2024-01-01', {}) AS listed_on, {} AS listed)"
    rules = [
        (entry.format("host", "x % 200", "true"), "x % 3 = 0"),
        (entry.format("host", "x % 200 + 40 + x % 50", "false"), "x % 3 = 0"),
        (entry.format("host", "x % 200 + 120 + x % 50", "true"), "x % 3 = 0 AND x % 2 = 0"),
        (entry.format("concat(host, '/en')", "x % 300", "true"), "x % 3 = 1"),
        (entry.format("parent", "y % 365", "true"), "parent != '' AND y % 5 = 0"),
    ]
    listed = F.array_compact(F.expr("array(" + ", ".join(f"if({when}, {row}, NULL)" for row, when in rules) + ")"))
    return named.select(F.explode(listed).alias("e")).select("e.*").distinct()


def url_lists_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_lists.judge(dated_captures(pages), dated_entries(pages))
    return judged.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "listed_on")})


def quoting_messages(turns: DataFrame) -> DataFrame:
    """Conversations as mail: each turn quotes the one before, and what that quoted; every fifth starts anew."""
    texts = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))

    def before(n: int) -> DataFrame:
        return texts.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("text").alias(f"text_{n}"))

    met = turns.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    once = F.when((F.col("turn") % 5 != 0) & F.col("text_1").isNotNull(), quote_links.quote(F.col("text_1")))
    twice = F.when(once.isNotNull() & (F.col("turn") % 5 != 1), quote_links.quote(quote_links.quote(F.col("text_2"))))
    return met.select("conv_id", "turn", "role", F.concat_ws("\n", twice, once, "text").alias("text"))


def quote_links_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return quote_links.conversations(quoting_messages(turns))


def source_mix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", crc_remainder("doc_id", 4) == 2)
    prototypes = language_id.train(docs.filter("NOT held_out"))
    judged = docs.withColumn("best", language_id.judge(prototypes)("text"))
    return judged.select("doc_id", "held_out", "best.lang_pred", "best.score")


def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = byte_bpe.codec(spark, RANKS, public_tokenizers.PATTERN)
    coded = read_table(spark, sf_dir, "documents").withColumn("coded", codec.round_trip("text"))
    return coded.select(
        "doc_id",
        byte_bpe.token_count(F.col("coded.ids")).alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.bytes", 256).alias("decoded_sha256"),
    )


def setsketch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"), words=2)


def prefix_forest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = prefix_forest.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def cap_filters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.9)


def hidden_markov_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return hidden_markov.score(docs.withColumn("held_out", crc_remainder("doc_id", 7) == 2))


def word_graph_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_graph.collocations(read_table(spark, sf_dir, "documents").select("text", "lang"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text, in a tenth of the documents with a stretch to the text's end that repeats its first words.

    Which ones, from where and with what period follows from crc32 of the doc_id as text (NULL: empty).
    """
    words = F.regexp_extract_all(whole_text(), F.lit(WORD), F.lit(0))
    numbered = docs.withColumn("h", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    chosen = numbered.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    chosen = chosen.withColumn("a", F.expr("if(n > 0, int((h div 10) % n), 0)"))
    chosen = chosen.withColumn("p", F.expr("int(1 + (n - a) div (3 + (h div 10) % 8))"))
    again = F.expr("transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % p)])")
    return chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def square_catchers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_period(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = docs.select("doc_id", square_catchers.periodic_runs()("text").alias("f")).select("doc_id", "f.*")
    found = found.withColumn("top", F.expr("array_min(transform(runs, r -> struct(-r.length AS shorter, r.start AS start, r.period AS period)))"))
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        (-F.col("top.shorter")).alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * -top.shorter div top.period").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def license_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_index.find_licenses(docs).select("doc_id", "licenses.*")
    found = found.withColumn("exact", F.expr("filter(places, p -> p.exact)"))

    def labels(places: str) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(F.col(f"{places}.label"))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("exact").cast("long").alias("n_base"),
        F.array_min("exact.start").alias("first_word"),
        F.array_max("exact.start").alias("last_word"),
        labels("exact").alias("base_labels"),
        labels("places").alias("labels"),
        F.coalesce(F.array_max("places.score"), F.lit(0.0)).alias("score"),
    )


_QUERIES = {
    "op1_suffix_dedup": suffix_dedup_query,
    "op2_url_lists": url_lists_query,
    "op3_source_mix": source_mix_query,
    "op4_language_id": language_id_query,
    "op5_quote_links": quote_links_query,
    "op6_byte_bpe": byte_bpe_query,
    "op7_setsketch": setsketch_query,
    "op8_prefix_forest": prefix_forest_query,
    "op9_cap_filters": cap_filters_query,
    "op10_hidden_markov": hidden_markov_query,
    "op11_word_graph": word_graph_query,
    "op12_square_catchers": square_catchers_query,
    "op13_license_index": license_index_query,
}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}
