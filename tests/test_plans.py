"""Sketches, amenities, label tables and the pivot; the rest without the training-data operators."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from rentpulse.functions import labels
from rentpulse.operators import sketches
from rentpulse.plans import amenities, dashboard

ROOT = Path(__file__).resolve().parents[1]


def test_distinct_sketches_roll_up(spark):
    rows = spark.range(60_000).selectExpr("id % 3 AS city", "id % 12 AS month", "id % 7919 AS guest")
    monthly = sketches.distinct_sketches(rows, ["city", "month"], "guest", "s")
    exact = {r.city: r.n for r in rows.groupBy("city").agg(F.countDistinct("guest").alias("n")).collect()}
    whole = {r.city: r.n for r in sketches.distinct_sketches(rows, ["city"], "guest", "s").select("city", sketches.distinct_estimate("s").alias("n")).collect()}
    rolled = sketches.roll_up_distinct(monthly, ["city"], "s").select("city", sketches.distinct_estimate("s").alias("n"))
    for r in rolled.collect():
        assert abs(r.n - exact[r.city]) <= exact[r.city] * sketches.distinct_error()
        assert abs(r.n - whole[r.city]) <= whole[r.city] * 0.01
    nulls = rows.select("city", F.lit(None).cast("bigint").alias("guest"))
    assert {r.n for r in sketches.distinct_sketches(nulls, ["city"], "guest", "s").select(sketches.distinct_estimate("s").alias("n")).collect()} == {0}


def test_quantile_sketches_merge_within_their_rank_error(spark):
    rows = spark.range(50_000).selectExpr("id % 2 AS city", "id % 10 AS month", "pow(id % 4999, 3) AS price")
    merged = sketches.roll_up_quantiles(sketches.quantile_sketches(rows, ["city", "month"], "price", "s"), ["city"], "s")
    for p in (0.0, 0.5, 0.95, 1.0):
        got = merged.select("city", sketches.quantile_estimate("s", p).alias("q"))
        ranks = rows.join(got, "city").groupBy("city").agg(F.avg(F.expr("int(price < q)")).alias("lo"), F.avg(F.expr("int(price <= q)")).alias("hi"))
        for r in ranks.collect():
            assert r.lo <= p + sketches.quantile_rank_error() and r.hi >= p - sketches.quantile_rank_error()
    nulls = rows.select("city", F.lit(None).cast("double").alias("price"))
    empty = sketches.quantile_sketches(nulls, ["city"], "price", "s").select(sketches.quantile_estimate("s", 0.5).alias("q"))
    assert {r.q for r in empty.collect()} == {None}


def test_amenities(spark):
    texts = ['["Wifi", "Kitchen", "Wifi"]', "[]", "", None, "no", '["a", null, " b "]', '{"a": 1}', '["cut', '["", "é\\u00e9"]', '"x"']
    rows = spark.createDataFrame([(i, "x", t) for i, t in enumerate(texts)], "listing_id bigint, city string, amenities string")
    parsed = {r.listing_id: r.a for r in rows.select("listing_id", amenities.amenity_list(F.col("amenities")).alias("a")).collect()}
    for i, text in enumerate(texts):
        try:
            wanted = json.loads(text)
        except (TypeError, ValueError):
            wanted = None
        wanted = [w for w in wanted if w is not None] if isinstance(wanted, list) else None
        assert parsed[i] == wanted
    bridge = amenities.listing_amenities(rows)
    assert sorted((r.listing_id, r.amenity) for r in bridge.collect()) == [(0, "Kitchen"), (0, "Wifi"), (5, "a"), (5, "b"), (8, "éé")]
    shares = {r.amenity: (r.n_listings, r.pct_listings) for r in amenities.amenity_shares(bridge, rows).collect()}
    assert shares["Wifi"] == (1, 10.0)


def test_label_tables_give_what_the_map_gives(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b c",), (None,)], "city string")
    table = spark.createDataFrame([("a", "Á"), ("a", "Ü"), (None, "none"), ("q", "Q")], "city string, label string")
    got = labels.join_labels(rows, table, "city", "ciudad")
    wanted = rows.withColumn("ciudad", labels.mapped_label(F.col("city"), {"a": "Á", "q": "Q"}))
    assert got.columns == wanted.columns and sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_pivot_has_a_column_per_profile(spark):
    rows = [("sevilla", "Host individual", 2), ("sevilla", "Host individual", 3), ("malaga", "Operador profesional", 7), ("malaga", "other", 1)]
    mart = spark.createDataFrame(rows, "city string, host_profile string, total_listings bigint")
    got = dashboard.listings_by_profile_wide(mart)
    assert got.columns == ["ciudad", "single_host", "multi_host", "professional_host"]
    assert sorted(map(tuple, got.collect())) == [("Málaga", 0, 0, 7), ("Sevilla", 5, 0, 0)]


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    """Also with the pipeline file still there."""
    without = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "*.md")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=without)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'mart_city' in q and set(s) <= set(q); print(len(q))"
    environment = {**os.environ, "PYTHONPATH": str(tmp_path / "repo")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=environment, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
