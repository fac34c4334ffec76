"""Tables under a manifest, the stored history, extracts with bad rows, bucketed tables and counted exports."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from rentpulse.operators import incremental, scd2
from rentpulse.sources import buckets, extracts, manifest, tables
from rentpulse.sources.change_log import ChangeLog

FACT = "city string, day date, listing_id bigint, price double"
KEYS, UNIQUE = ["city", "day"], ["listing_id", "day"]


def day(text):
    return dt.date.fromisoformat(f"2026-{text}")


def load(spark, path, rows):
    return incremental.incremental_load(spark.createDataFrame(rows, FACT), path, KEYS, UNIQUE)


def stored(spark, path, version=None):
    schema = spark.createDataFrame([], FACT).schema
    return sorted(map(tuple, manifest.read_live(spark, path, schema, KEYS, version).collect()))


FIRST = [("x", day("07-02"), 1, 1.0), ("x", day("07-02"), 2, 2.0), ("a b/ñ:%+", day("07-03"), 3, 3.0), ("z", day("06-01"), 9, 9.0)]
# Listing 1 moves, listing 9 moves and leaves its partition empty, listing 3 stays.
SECOND = [("y", day("07-02"), 1, 10.0), ("y", day("06-01"), 9, 90.0), ("x", day("07-02"), 7, 7.0)]
BOTH = sorted([("y", day("07-02"), 1, 10.0), ("y", day("06-01"), 9, 90.0), FIRST[1], FIRST[2]])


def test_a_load_replaces_moved_rows_at_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    load(spark, path, FIRST)
    assert stored(spark, path) == sorted(FIRST)
    load(spark, path, SECOND)
    assert stored(spark, path) == BOTH
    assert stored(spark, path, manifest.versions(spark, path)[-2]) == sorted(FIRST)  # for readers that have begun
    load(spark, path, SECOND)  # nothing unseen: no new version
    assert len(manifest.versions(spark, path)) == 2
    load(spark, path, [("n", day("07-09"), 11, 1.0)])
    assert stored(spark, path) == sorted([*BOTH, ("n", day("07-09"), 11, 1.0)])
    assert len(manifest.versions(spark, path)) == 2  # the newest and the one before


class Died(Exception):
    pass


def die_at(monkeypatch, point):
    """Let a commit die: after the rows are written, with a half-written manifest, or right after the swap."""

    def died(*args):
        raise Died

    if point == "rows":
        monkeypatch.setattr(manifest, "_partitions_of", died)
    elif point == "manifest":
        written = manifest.version_path

        def half(base, version):
            path = written(base, version)
            if base.endswith("_manifests") and version == 2:
                tables_path = f"{path}/part-half.parquet"
                import os

                os.makedirs(path, exist_ok=True)
                with open(tables_path, "wb") as out:
                    out.write(b"half")
                raise Died
            return path

        monkeypatch.setattr(manifest, "version_path", half)
    else:
        monkeypatch.setattr(manifest, "remove_folder", died)


@pytest.mark.parametrize("point", ["rows", "manifest"])
def test_a_load_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch, point):
    path = str(tmp_path / "fact")
    load(spark, path, FIRST)
    with monkeypatch.context() as broken:
        die_at(broken, point)
        with pytest.raises(Died):
            load(spark, path, SECOND)
    assert stored(spark, path) == sorted(FIRST)
    load(spark, path, SECOND)  # the next one goes through
    assert stored(spark, path) == BOTH
    loads = [f for f in tables.list_folder(spark, path) if f.startswith("load=")]
    assert len(loads) == 2  # what the dead load wrote is gone


def test_a_load_that_dies_after_the_swap_shows_the_new_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    load(spark, path, FIRST)
    load(spark, path, [("n", day("07-09"), 11, 1.0)])
    with monkeypatch.context() as broken:
        die_at(broken, "sweep")
        with pytest.raises(Died):
            load(spark, path, SECOND)
    assert stored(spark, path) == sorted([*BOTH, ("n", day("07-09"), 11, 1.0)])


def test_superseded_partitions_go_after_their_last_reader_version(spark, tmp_path):
    path = str(tmp_path / "fact")
    load(spark, path, FIRST)
    load(spark, path, SECOND)
    for n in range(3):
        load(spark, path, [("n", day(f"08-0{n + 1}"), 100 + n, 1.0)])
    first = next(f for f in tables.list_folder(spark, path) if f.startswith("load=00000001"))
    kept = [d for city in tables.list_folder(spark, f"{path}/{first}") for d in tables.list_folder(spark, f"{path}/{first}/{city}")]
    assert kept == ["day=2026-07-03"]
    assert len(stored(spark, path)) == len(BOTH) + 3


def test_seen_partitions_come_from_the_manifest(spark, tmp_path):
    path = str(tmp_path / "fact")
    load(spark, path, FIRST)
    df = spark.createDataFrame(SECOND, FACT)
    seen = manifest.live_partitions(spark, path, df.schema, KEYS)
    assert all("/_manifests/" in file for file in seen.inputFiles())
    assert sorted(r.listing_id for r in incremental.unseen_partitions(df, seen, KEYS).collect()) == [1, 9]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert load(spark, path, []).count() == 0
    assert load(spark, path, FIRST).count() == 4
    assert load(spark, path, []).count() == 4


HOSTS = "sk string, n bigint, name string"


def plain_history(states):
    """Versions (key, n, from, to) after seeing the states, by day."""
    closed, live = [], {}
    for as_of, state in states:
        for sk, (n, since) in list(live.items()):
            if state.get(sk) != n:
                closed.append((sk, n, since, as_of))
                del live[sk]
        for sk, n in state.items():
            live.setdefault(sk, (n, as_of))
    return closed + [(sk, n, since, None) for sk, (n, since) in live.items()]


def test_history_opens_a_bounded_number_of_folders(spark, tmp_path):
    """After 50 runs, with the rows that the states tell."""
    schema = scd2.scd2_first_load(spark.createDataFrame([], HOSTS), day("01-01")).schema
    log = ChangeLog(spark, str(tmp_path / "log"), "sk", schema)
    states = []
    for run in range(50):
        state = {f"h{k}": run // (k + 3) for k in range(6) if (run + k) % 11}
        as_of = day("01-01") + dt.timedelta(days=run)
        rows = spark.createDataFrame([(sk, n, "n") for sk, n in state.items()], HOSTS).coalesce(1)
        step = scd2.scd2_first_load(rows, as_of)
        if states:
            step = scd2.scd2_step(log.open_versions(), rows, "sk", ["n"], as_of, changes_only=True)
        log.append(step.coalesce(1))
        states.append((as_of, state))
        assert len(log.folders()) <= 11
    assert len(log.runs()) <= 20
    got = [(r.sk, r.n, r.valid_from, r.valid_to) for r in log.history().collect()]
    assert len(got) > 60 and sorted(got, key=str) == sorted(plain_history(states), key=str)
    assert {r.sk: r.n for r in log.open_versions().collect()} == states[-1][1]


def test_a_checkpoint_that_dies_does_not_count(spark, tmp_path):
    schema = scd2.scd2_first_load(spark.createDataFrame([], HOSTS), day("01-01")).schema
    log = ChangeLog(spark, str(tmp_path / "log"), "sk", schema, every=2)
    one = spark.createDataFrame([("a", 1, "n")], HOSTS)
    two = spark.createDataFrame([("a", 2, "n"), ("b", 1, "n")], HOSTS)
    log.append(scd2.scd2_first_load(one, day("01-01")))
    log.append(scd2.scd2_step(log.open_versions(), two, "sk", ["n"], day("01-02"), changes_only=True))
    before = sorted(map(str, log.history().collect()))
    assert log.folders()[0].startswith(log.checkpoints)
    (tmp_path / "log_checkpoint" / "version=2" / "_SUCCESS").unlink()
    assert len(log.folders()) == 2 and sorted(map(str, log.history().collect())) == before


def write_gz(path, text):
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write(text)
    return str(path)


def test_bad_rows_stop_a_load_or_are_set_aside(spark, tmp_path):
    folder = tmp_path / "a b+c"
    folder.mkdir()
    one = write_gz(folder / "one.csv.gz", 'id,name,price\n1,"a, b",3\n2,short\n3,x,4,long\n4,"two\nlines",\n')
    two = write_gz(folder / "two.csv.gz", "price,id\n7,5\n")
    bronze, aside = str(tmp_path / "bronze"), str(tmp_path / "aside")
    with pytest.raises(extracts.BadRowsError, match="'sevilla': 2"):
        extracts.load_listings(spark, {"sevilla": one, "malaga": two}, bronze)
    assert not tables.table_exists(spark, bronze)
    for _ in range(2):
        loaded = extracts.load_listings(spark, {"sevilla": one, "malaga": two}, bronze, quarantine=aside)
        assert loaded == {"sevilla": 2, "malaga": 1}
        assert sorted((r.city, r.row) for r in spark.read.parquet(aside).collect()) == [("sevilla", "2,short"), ("sevilla", "3,x,4,long")]
    assert sorted((r.id, r.price) for r in spark.read.parquet(bronze).collect()) == [("1", "3"), ("4", None), ("5", "7")]
    mended = write_gz(folder / "mended.csv.gz", "id,name,price\n2,short,1\n")
    extracts.load_listings(spark, {"sevilla": mended}, bronze, quarantine=aside)
    schema = extracts.text_schema(["file", "row", "city"])
    assert tables.read_table(spark, aside, schema).count() == 0
    reviews = write_gz(folder / "r.csv.gz", "a,b,c,d,e,f\n1,100,2026-05-03,7,Li,ok\n1,101\n")
    with pytest.raises(extracts.BadRowsError):
        extracts.load_reviews(spark, {"sevilla": reviews}, str(tmp_path / "reviews"))


def test_files_with_one_header_are_one_scan(spark, tmp_path):
    files = {c: write_gz(tmp_path / f"{c}.csv.gz", f"id,name\n{c}1,x\n") for c in ("a", "b", "c")}
    scan = extracts.scan_listings(spark, files)
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    assert sorted((r.city, r.id) for r in scan.collect()) == [("a", "a1"), ("b", "b1"), ("c", "c1")]
    assert scan.columns == [*extracts.LISTING_COLUMNS, "city", "file", extracts.BAD_ROW]


def test_empty_extracts(spark, tmp_path):
    nothing = write_gz(tmp_path / "nothing.csv.gz", "")
    header = write_gz(tmp_path / "header.csv.gz", "id,name\n")
    path = str(tmp_path / "bronze")
    with pytest.raises(ValueError, match="no incoming rows"):
        extracts.load_listings(spark, {"a": nothing, "b": header}, path)
    assert extracts.load_listings(spark, {"a": nothing, "b": header}, path, allow_empty=True) == {"a": 0, "b": 0}


def test_bucketed_tables_join_without_an_exchange(spark):
    fact = spark.range(500).selectExpr("id % 97 AS listing_id", "id AS n")
    listings = spark.range(80).selectExpr("id AS listing_id", "concat('p', id) AS place")
    stored_fact = buckets.write_bucketed(fact, "f", "listing_id", 4)
    stored_listings = buckets.write_bucketed(listings, "l", "listing_id", 4)
    met = stored_fact.join(stored_listings.hint("merge"), "listing_id", "left")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sorted(map(tuple, met.collect()), key=str) == sorted(map(tuple, fact.join(listings, "listing_id", "left").collect()), key=str)


def test_an_export_counts_while_it_writes(spark, tmp_path, monkeypatch):
    def no_read(*args, **kwargs):
        raise AssertionError("reads a table it has just written")

    monkeypatch.setattr(tables, "read_table", no_read)
    empty = spark.range(0)
    results = tables.export_tables({"n": spark.range(1234).withColumn("x", F.lit(1)), "none": empty}, str(tmp_path))
    assert [(r.name, r.rows, r.error) for r in results] == [("n", 1234, None), ("none", 0, None)]
