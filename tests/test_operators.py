import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.operators import dedup, incremental, joins, percentile, quality, scd2, winsorize
from rentpulse.sources import tables


def day(text):
    return dt.date.fromisoformat(f"2026-{text}")


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.mark.parametrize(("cell_values", "p"), [(200_000, 0.0), (200_000, 0.95), (1, 0.5), (1, 1.0), (3, 0.95)])
def test_percentile_matches_numpy(spark, monkeypatch, p, cell_values):
    monkeypatch.setattr(percentile, "CELL_VALUES", cell_values)
    rng = random.Random(7)
    groups = {
        "hot": [round(rng.lognormvariate(4, 1), 2) for _ in range(3000)] + [92150.0],
        "ties": [10.0] * 50 + [20.0] * 50,
        "negative": [rng.uniform(-5, 5) for _ in range(101)],
        "single": [3.25],
        "zero": [0.0, 0.0, 1e-9],
        None: [1.0, 2.0],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    out = percentile.group_percentile(df, ["g"], "v", p, "q").collect()
    result = {r.g: r.q for r in out}
    assert set(result) == set(groups)
    for g, values in groups.items():
        assert result[g] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_percentile_moves_the_values_once(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "cast(id AS double) AS v")
    out = percentile.group_percentile(df, ["g"], "v", 0.5, "q")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "Range (" not in plan


def test_percentile_of_many_values_in_one_bin(spark):
    """A million values below the width of one bin are cut by their counted number."""
    df = spark.range(1_000_000).selectExpr("1 AS g", "id / 1e9 AS v")
    assert df.select(percentile._log_bin(F.col("v"))).distinct().count() == 1
    got = percentile.group_percentile(df, ["g"], "v", 0.95, "q").first().q
    assert got == pytest.approx(0.95 * 999_999 / 1e9, rel=1e-12)


def test_winsorize_keeps_rows_and_nulls(spark):
    data = [("a", float(v)) for v in range(1, 101)] + [("a", None), ("b", None), (None, 5.0)]
    df = spark.createDataFrame(data, "g string, v double")
    out = winsorize.winsorize(df, "v", ["g"], 0.95, "w")
    assert out.count() == len(data)
    result = {(r.g, r.v): r.w for r in out.collect()}
    assert result[("a", 100.0)] == pytest.approx(95.05)
    assert result[("a", 50.0)] == 50.0
    assert result[("a", None)] is None
    assert result[("b", None)] is None
    assert result[(None, 5.0)] is None


def test_latest_window_keeps_the_whole_snapshot(spark):
    data = [
        ("x", 1, day("06-20")),
        ("x", 2, day("06-24")),
        ("x", 3, day("07-02")),
        ("x", 1, day("06-27")),
        ("x", 4, day("03-25")),
        ("y", 5, day("03-01")),
        (None, 6, day("03-01")),
        ("x", 7, None),
    ]
    df = spark.createDataFrame(data, "city string, id int, d date")
    out = dedup.latest_window(df, "city", "id", "d", 30)
    kept = {(r.city, r.id): r.d for r in out.collect()}
    assert kept == {
        ("x", 1): day("06-27"),
        ("x", 2): day("06-24"),
        ("x", 3): day("07-02"),
        ("y", 5): day("03-01"),
        (None, 6): day("03-01"),
    }


def test_latest_window_ignores_older_snapshots(spark):
    new = spark.createDataFrame([("x", i, day("06-20")) for i in range(20)], "city string, id int, d date")
    old = spark.createDataFrame([("x", i, day("03-20")) for i in range(40)], "city string, id int, d date")
    assert rows(dedup.latest_window(new.union(old), "city", "id", "d", 30)) == rows(new)


def test_latest_window_reads_only_the_partitions_it_needs(spark, tmp_path):
    rows_ = [(c, i, day(d)) for c in "xy" for i in range(5) for d in ("01-10", "03-20", "06-20", "06-25")]
    spark.createDataFrame(rows_, "city string, id int, d date").write.partitionBy("city", "d").parquet(str(tmp_path / "t"))
    stored = spark.read.schema("id int, city string, d date").parquet(str(tmp_path / "t"))
    out = dedup.within_latest(stored, "city", "d", 30)
    assert {str(r.d) for r in out.collect()} == {"2026-06-20", "2026-06-25"} and out.count() == 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_keep_first_is_deterministic_and_cut_before_the_shuffle(spark):
    data = [(1, 5, i) for i in range(200)] + [(2, 1, 0), (None, 2, 1), (None, 2, 2)]
    df = spark.createDataFrame(data, "k int, o int, x int")
    picks = {tuple(rows(dedup.keep_first(df.repartition(n), ["k"], [F.col("o").desc()]).na.fill(-1))) for n in (1, 3, 7)}
    assert len(picks) == 1
    assert len(picks.pop()) == 3
    plan = dedup.keep_first(df, ["k"], [F.col("o").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


FACT = "city string, snapshot_date date, listing_id bigint, price double"


def load(spark, path, data):
    df = spark.createDataFrame(data, FACT)
    return incremental.incremental_load(df, path, ["city", "snapshot_date"], ["listing_id", "snapshot_date"])


def test_incremental_load(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = [("x", day("07-02"), 1, 10.0), ("x", day("06-20"), 2, 20.0), ("z", day("06-28"), 9, 1.0)]
    load(spark, path, first)
    again = load(spark, path, first)
    assert rows(again, "listing_id", "price") == [(1, 10.0), (2, 20.0), (9, 1.0)]

    # An older date of another city loads; a known partition stays as it was loaded.
    out = load(spark, path, [("y", day("06-28"), 3, 30.0), ("x", day("07-02"), 4, 40.0), ("x", day("07-02"), 1, 99.0)])
    assert rows(out, "listing_id", "price") == [(1, 10.0), (2, 20.0), (3, 30.0), (9, 1.0)]

    # A listing that arrives through a second city on a stored date replaces the stored row, also
    # where that empties the old partition.
    out = load(spark, path, [("w", day("07-02"), 1, 11.0), ("w", day("06-28"), 9, 2.0)])
    assert rows(out, "city", "listing_id", "price") == [("w", 1, 11.0), ("w", 9, 2.0), ("x", 2, 20.0), ("y", 3, 30.0)]


def test_incremental_load_equals_full_load(spark, tmp_path):
    data = [(c, day(d), i + 100 * n, float(i)) for n, c in enumerate("xyz") for d in ("06-20", "06-21") for i in range(5)]
    whole = rows(load(spark, str(tmp_path / "whole"), data), "city", "listing_id", "price")
    for city in "zxy":
        parts = load(spark, str(tmp_path / "parts"), [r for r in data if r[0] == city])
    assert rows(parts, "city", "listing_id", "price") == whole


def test_incremental_load_refuses_null_partition(spark, tmp_path):
    with pytest.raises(ValueError, match="NULL"):
        load(spark, str(tmp_path / "fact"), [("x", None, 1, 1.0)])


HOSTS = "sk string, n bigint, profile string, name string"


def test_scd2(spark):
    check = ["n", "profile"]
    one = spark.createDataFrame(
        [("same", 1, "a", "Ann"), ("changed", 1, "a", "Bob"), ("gone", 2, "b", "Cy"), ("to_null", 3, "c", "Di")], HOSTS
    )
    two = spark.createDataFrame(
        [("same", 1, "a", "Renamed"), ("changed", 6, "p", "Bob"), ("new", 1, "a", "Eve"), ("to_null", None, "c", "Di")],
        HOSTS,
    )
    first = scd2.scd2_first_load(one, day("03-31"))
    second = scd2.scd2_apply(first, two, "sk", check, day("07-02"))
    closed = [("changed", 1), ("gone", 2), ("to_null", 3)]
    assert rows(second.filter("not is_current"), "sk", "n") == closed
    assert {r.sk: r.name for r in scd2.scd2_current(second).collect()} == {
        "same": "Ann",
        "changed": "Bob",
        "new": "Eve",
        "to_null": "Di",
    }
    # The same input again changes nothing.
    again = scd2.scd2_apply(second, two, "sk", check, day("08-01"))
    assert rows(again.drop("n")) == rows(second.drop("n"))
    # A vanished key that returns gets a fresh version; the closed one stays.
    third = scd2.scd2_apply(second, one, "sk", check, day("10-01"))
    assert third.filter("sk = 'gone'").count() == 2
    assert rows(scd2.scd2_as_of(third, day("05-01")), "sk") == rows(one, "sk")
    assert rows(scd2.scd2_as_of(third, day("07-02")), "sk") == rows(two, "sk")
    assert rows(scd2.scd2_changed(second, "sk", check), "sk", "old_n") == [("changed", 1), ("to_null", 3)]
    # At any day a key has at most one version.
    overlaps = third.groupBy("sk").agg(F.count_if("is_current").alias("open")).filter("open > 1")
    assert overlaps.isEmpty()


def test_rows_without_a_key_are_spread(spark):
    """A shuffled join deals them over all tasks, and gives what a plain join gives."""
    left = spark.range(4000).selectExpr("id AS n", "if(id % 4 = 0, id % 50, NULL) AS k", "if(id % 3 = 0, NULL, 'c') AS city")
    right = spark.range(40).selectExpr("id AS k", "'c' AS city", "concat('v', id) AS v").unionByName(
        spark.createDataFrame([(None, "c", "none")], "k long, city string, v string")
    )
    got = joins.left_join_known(left, right.hint("merge"), ["k", "city"], "n")
    assert got.columns == ["k", "city", "n", "v"]
    assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, ["k", "city"], "left").collect()))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"SortMergeJoin \[k#\d+L, city#\d+, __spread#\d+L\]", plan), plan


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, None)], "k int, v string")
    assert rows(quality.null_counts(df, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert rows(quality.not_null(df.filter("k = 1"), ["k", "v"])) == []
    assert rows(quality.unique(df, "k")) == [(1, 2)]
    assert [tuple(r) for r in quality.unique_combination(df, ["k", "v"]).collect()] == [(None, "a", 2)]
    assert rows(quality.accepted_values(df, "v", ["a"], "warn")) == [("b", 1, "warn")]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.relationships(df, "k", parent, "id")) == [(2, 1)]


def test_reconciliation_finds_missing_groups(spark):
    fact = spark.createDataFrame([("x", 100), ("y", 100), ("z", 100)], "city string, n bigint")
    mart = spark.createDataFrame([("x", 96), ("y", 90), ("w", 1)], "city string, n bigint")
    out = quality.count_reconciliation(mart, fact, "city", "m", 5.0, R.COUNT_MESSAGE)
    assert rows(out, "city", "detail") == [
        ("w", "listings: fact=0 vs mart=1 (diff n/a% > 5%)"),
        ("y", "listings: fact=100 vs mart=90 (diff 10.0% > 5%)"),
        ("z", "listings: fact=100 vs mart=0 (diff 100.0% > 5%)"),
    ]


def test_coverage_floor(spark):
    data = [("x", 1.0), ("x", None), ("x", None), ("y", 1.0)]
    df = spark.createDataFrame(data, "city string, revenue double")
    out = quality.coverage_floor(df, "revenue", "city", "m", 40.0, R.COVERAGE_MESSAGE)
    assert rows(out) == [("m", "x", "cobertura revenue: 1/3 hosts (33.3% < 40%)")]


def test_reload_group(spark, tmp_path):
    path = str(tmp_path / "bronze")
    schema = "id string, city string"
    tables.append_rows(spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "y")], schema), path, ["city"])

    def stored():
        return rows(tables.read_table(spark, path), "id", "city")

    update = spark.createDataFrame([("4", "y"), ("5", "z")], schema)
    for _ in range(2):
        assert tables.reload_group(update, path, "city", ["y"]) == {"y": 1}
        assert stored() == [("1", "x"), ("4", "y")]
    with pytest.raises(ValueError, match="no incoming rows"):
        tables.reload_group(update, path, "city", ["x"])
    assert stored() == [("1", "x"), ("4", "y")]
    assert tables.reload_group(update, path, "city", ["x"], allow_empty=True) == {"x": 0}
    assert stored() == [("4", "y")]


def test_reload_tasks_take_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """Also of groups that are far larger than others; small groups share a task."""
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100, raising=False)
    path = str(tmp_path / "bronze")
    df = spark.range(1000).selectExpr("id", "if(id < 960, 'x', concat('y', id % 20)) AS city", "cast(NULL AS string) AS none").repartition(1)
    groups = ["x", *[f"y{i}" for i in range(20)]]
    assert sum(tables.reload_group(df, path, "city", groups).values()) == 1000
    stored = tables.read_table(spark, path, df.schema).withColumn("file", F.col("_metadata.file_name"))
    assert rows(stored, "id", "city", "none") == rows(df, "id", "city", "none")
    assert max(r["count"] for r in stored.groupBy("file").count().collect()) < 150
    assert stored.select(F.substring("file", 1, 10)).distinct().count() == 10


def test_export_reports_failures_and_goes_on(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, Name string")
    bad = good.select(F.raise_error(F.lit("broken")).alias("x"))
    results = tables.export_tables({"bad": bad, "good": good}, str(tmp_path))
    assert [r.name for r in results if r.error] == ["bad"]
    summary = tables.export_summary(results)
    assert summary["tables"] == 1 and summary["rows"] == 2 and summary["megabytes"] > 0
    assert spark.read.parquet(str(tmp_path / "good.parquet")).columns == ["id", "name"]
