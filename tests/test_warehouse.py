import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.plans import dashboard, marts
from rentpulse.plans.warehouse import PublishedWarehouse, Warehouse
from rentpulse.rules import RentalRules
from rentpulse.sources import extracts, tables

RULES = RentalRules(as_of=dt.date(2026, 7, 15))


def listing(**given):
    row = {
        "id": "1",
        "last_scraped": "2026-07-02",
        "host_id": "10",
        "host_name": "Ann",
        "neighbourhood_cleansed": "Triana",
        "room_type": R.ENTIRE_HOME,
        "accommodates": "2",
        "price": "$100.00",
        "availability_365": "200",
        "number_of_reviews_ltm": "3",
        "estimated_occupancy_l365d": "50",
        "calculated_host_listings_count": "1",
        "calculated_host_listings_count_entire_homes": "1",
        "city": "sevilla",
    }
    return {**row, **given}


def raw(spark, rows):
    schema = extracts.text_schema([*extracts.LISTING_COLUMNS, "city"])
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def reviews(spark, rows=()):
    return spark.createDataFrame(list(rows), extracts.text_schema([*extracts.REVIEW_COLUMNS, "city"]))


def warehouse(spark, rows):
    return Warehouse(raw(spark, rows), reviews(spark), RULES)


def test_padded_neighbourhoods_meet_and_unassigned_ones_have_no_key(spark):
    wh = warehouse(
        spark,
        [
            listing(id="1", neighbourhood_cleansed=" Triana "),
            listing(id="2"),
            listing(id="3", neighbourhood_cleansed="no asignado"),
            listing(id="4", neighbourhood_cleansed=None),
            listing(id="5", city="malaga"),
        ],
    )
    assert wh.dim_neighbourhood.count() == 2
    keys = {r.listing_id: r.neighbourhood_id for r in wh.fact_listings.collect()}
    assert keys[1] == keys[2] != keys[5]
    assert keys[3] is None and keys[4] is None
    mart = wh.mart_neighbourhood_pressure.collect()
    assert sorted((r.city, r.total_listings) for r in mart) == [("malaga", 1), ("sevilla", 2)]


def test_dim_host_keeps_the_most_complete_record(spark):
    wh = warehouse(
        spark,
        [
            listing(id="1", calculated_host_listings_count=None),
            listing(id="2", calculated_host_listings_count="6", calculated_host_listings_count_entire_homes="5"),
            listing(id="3", calculated_host_listings_count="2"),
            listing(id="4", host_id="bad"),
            listing(id="5", city="malaga"),
        ],
    )
    hosts = {(r.host_id, r.city): r for r in wh.dim_host.collect()}
    assert set(hosts) == {(10, "sevilla"), (10, "malaga")}
    assert hosts[10, "sevilla"].host_profile == R.PROFESSIONAL_HOST and hosts[10, "sevilla"].is_multihost
    profiles = {r.listing_id: r.host_profile for r in wh.fact_listings.collect()}
    assert profiles[1] == R.PROFESSIONAL_HOST and profiles[4] is None and profiles[5] == R.SINGLE_HOST


def test_fact_has_one_row_per_listing_and_date(spark):
    rows = [listing(), listing(), listing(last_scraped="2026-06-20"), listing(city="malaga")]
    fact = warehouse(spark, rows).fact_listings.collect()
    assert sorted((r.city, str(r.snapshot_date)) for r in fact) == [("malaga", "2026-07-02"), ("sevilla", "2026-06-20")]


def test_money_columns(spark):
    cheap = [listing(id=str(i), price=f"${i}.00") for i in range(1, 101)]
    rows = cheap + [
        listing(id="200", price="$92,150.00", accommodates="0", estimated_occupancy_l365d="0"),
        listing(id="201", price=None),
    ]
    fact = {r.listing_id: r for r in warehouse(spark, rows).fact_listings.collect()}
    assert fact[200].price_winsorized == pytest.approx(96.0)
    assert fact[200].price_per_person is None and fact[200].estimated_revenue_adjusted is None
    assert fact[201].price_winsorized is None and not fact[201].is_active_listing
    assert fact[50].price_per_person == 25.0 and fact[50].estimated_revenue_adjusted == 2500.0


def test_hosts_without_listings_in_the_window_stay(spark):
    wh = warehouse(
        spark,
        [
            listing(),
            listing(id="2", host_id="11", last_scraped="2026-03-25"),
            listing(id="3", host_id="12", estimated_occupancy_l365d="0"),
        ],
    )
    revenue = {r.host_id: r.estimated_annual_revenue for r in wh.mart_host_profile.collect()}
    assert revenue == {10: 5000.0, 11: None, 12: None}
    city = wh.mart_city_comparison.first()
    assert (city.total_listings, city.total_hosts) == (2, 2)


def test_broken_marts_are_caught(spark):
    rows = [listing(id=str(i), host_id=str(i), last_scraped=f"2026-06-{20 + i % 10}") for i in range(40)]
    wh = warehouse(spark, rows)
    assert wh.marts_consistency().isEmpty()
    narrow = RentalRules(as_of=RULES.as_of, window_days=0)
    sliver = marts.window_listings(wh.fact_listings, wh.dim_listing, narrow)
    broken = Warehouse(wh.raw_listings, wh.raw_reviews, RULES)
    broken.__dict__.update(
        window_listings=wh.window_listings,
        mart_city_comparison=marts.mart_city_comparison(sliver, wh.dim_host),
        mart_neighbourhood_pressure=marts.mart_neighbourhood_pressure(sliver, RULES),
        mart_host_profile=marts.mart_host_profile(wh.dim_host, sliver),
    )
    failures = broken.marts_consistency().collect()
    assert {r.mart for r in failures} == {
        "mart_city_comparison",
        "mart_neighbourhood_pressure",
        "mart_host_profile",
    }


def test_a_fault_in_the_shared_window_is_caught(spark, monkeypatch):
    """The marts read one window table; its check must not."""
    rows = [listing(id=str(i), host_id=str(i), last_scraped=f"2026-06-{20 + i % 10}") for i in range(40)]
    wh = warehouse(spark, rows)
    right = marts.within_latest
    monkeypatch.setattr(marts, "within_latest", lambda df, group, date, days: right(df, group, date, 0))
    failures = {r.mart for r in wh.marts_consistency().collect()}
    assert failures >= {"mart_city_comparison", "mart_neighbourhood_pressure"}


def test_published_build_is_idempotent_and_keeps_history(spark, tmp_path):
    review = [("1", "100", "2026-05-03", "7", "Guest", "ok", "sevilla"), ("1", "101", "", "8", "Guest", "ok", "sevilla")]
    june = [listing(), listing(id="2", host_id="11")]
    first = PublishedWarehouse(str(tmp_path), raw(spark, june), reviews(spark, review), RULES)
    assert first.build(dt.date(2026, 7, 15)).isEmpty()
    again = PublishedWarehouse(str(tmp_path), raw(spark, june), reviews(spark, review), RULES)
    assert again.build(dt.date(2026, 7, 16)).isEmpty()
    assert again.fact_listings.count() == 2
    assert again.host_history(dt.date(2026, 7, 17)).count() == 2

    september = june + [
        listing(
            last_scraped="2026-09-20",
            calculated_host_listings_count="6",
            calculated_host_listings_count_entire_homes="5",
        )
    ]
    later = PublishedWarehouse(str(tmp_path), raw(spark, september), reviews(spark, review), RULES)
    failed = later.build(dt.date(2026, 9, 30))
    assert {(r.check_name, r.table_name) for r in failed.collect()} == {
        ("unique_combination", t)
        for t in ("stg_details", "stg_host", "stg_location", "stg_availability", "stg_review_scores")
    }
    assert later.fact_listings.count() == 3
    history = later.host_history(dt.date(2026, 10, 1))
    assert sorted((r.host_id, r.is_current) for r in history.collect()) == [(10, False), (10, True), (11, True)]
    assert later.mart_city_comparison.first().total_listings == 1

    results = later.export(str(tmp_path / "export"))
    assert [r.error for r in results] == [None] * 7
    assert spark.read.parquet(str(tmp_path / "export" / "fact_reviews_monthly.parquet")).count() == 1


def write_gz(path, text):
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write(text)
    return str(path)


def test_a_bad_scrape_date_does_not_stop_the_load(spark, tmp_path):
    rows = [listing(), listing(id="2", last_scraped="n/a"), listing(id="3", city=None)]
    wh = PublishedWarehouse(str(tmp_path), raw(spark, rows), reviews(spark), RULES)
    assert [r.listing_id for r in wh.fact_listings.collect()] == [1]
    assert sorted(r.id for r in wh.rejected_listings.collect()) == ["2", "3"]
    failed = {(r.check_name, r.detail) for r in wh.failed_checks().filter("check_name = 'rejected'").collect()}
    assert failed == {("rejected", "1 rows without a usable key in sevilla"), ("rejected", "1 rows without a usable key in no city")}


def test_history_stores_changes_only(spark, tmp_path):
    rows = [listing(id=str(i), host_id=str(i)) for i in range(20)]
    for day in (15, 16, 17):
        PublishedWarehouse(str(tmp_path), raw(spark, rows), reviews(spark), RULES).host_history(dt.date(2026, 7, day))
    assert spark.read.parquet(str(tmp_path / "dim_host_snapshot")).count() == 20
    moved = [listing(id="0", host_id="0", calculated_host_listings_count="9"), *rows[2:]]
    history = PublishedWarehouse(str(tmp_path), raw(spark, moved), reviews(spark), RULES).host_history(dt.date(2026, 7, 20))
    assert spark.read.parquet(str(tmp_path / "dim_host_snapshot")).count() == 20 + 3
    assert history.filter("is_current").count() == 19 and history.count() == 21
    assert {(r.host_id, r.is_current) for r in history.filter("host_id < 2").collect()} == {(0, False), (0, True), (1, False)}


def test_a_failed_publication_keeps_the_old_table(spark, tmp_path):
    base = str(tmp_path / "t")
    tables.publish_version(spark.range(3), base)
    with pytest.raises(Exception, match="broken"):
        tables.publish_version(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), base)
    assert tables.latest_version(spark, base).count() == 3
    for n in (4, 5):
        tables.publish_version(spark.range(n), base)
    assert tables.latest_version(spark, base).count() == 5 and len(tables.complete_versions(spark, base)) == 2


def test_reloads_check_before_they_write(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "a:b")], "id int, city string")
    tables.append_rows(rows, path, ["city"])
    with pytest.raises(ValueError, match="no incoming rows"):
        tables.reload_group(rows.filter("city = 'y'").withColumn("id", F.lit(9)), path, "city", ["y", "x"])
    assert sorted(r.id for r in tables.read_table(spark, path, rows.schema).collect()) == [1, 2, 3]
    assert tables.reload_group(rows.limit(0), path, "city", ["a:b"], allow_empty=True) == {"a:b": 0}
    assert sorted(r.id for r in tables.read_table(spark, path, rows.schema).collect()) == [1, 2]


def test_csv_ingest(spark, tmp_path):
    one = write_gz(
        tmp_path / "one.csv.gz",
        'name,id,extra,price,host_name\n"A ""nice""\nplace",1,x,"$1,000.00",NA\nplain,2,y,,null\n',
    )
    two = write_gz(tmp_path / "two.csv.gz", "id,room_type\n3,Private room\n")
    path = str(tmp_path / "bronze")
    assert extracts.load_listings(spark, {"sevilla": one, "malaga": two}, path) == {"sevilla": 2, "malaga": 1}
    assert extracts.load_listings(spark, {"sevilla": one}, path) == {"sevilla": 2}
    stored = {r.id: r for r in spark.read.parquet(path).collect()}
    assert len(stored) == 3 and len(stored["1"]) == 80
    assert stored["1"].name == 'A "nice"\nplace' and stored["1"].price == "$1,000.00"
    assert stored["1"].host_name is None and stored["2"].price is None and stored["2"].host_name is None
    assert stored["3"].city == "malaga" and stored["3"].name is None and stored["3"].room_type == "Private room"

    file = write_gz(tmp_path / "r.csv.gz", 'a,b,c,d,e,f\n1,100,2026-05-03,7,"Li, Wu","so\nso"\n1,101,NA,8,,\n')
    path = str(tmp_path / "reviews")
    assert extracts.load_reviews(spark, {"sevilla": file}, path) == {"sevilla": 2}
    stored = {r.id: r for r in spark.read.parquet(path).collect()}
    assert stored["100"].reviewer_name == "Li, Wu" and stored["100"].comments == "so\nso"
    assert stored["101"].date is None and stored["101"].comments is None


def test_dashboard_drill_down_and_empty_selection(spark):
    rows = [listing(id=str(i), host_id=str(i), city=c) for i, c in enumerate(["sevilla", "malaga", "malaga"])]
    wh = warehouse(spark, rows)
    city, place, host = wh.mart_city_comparison, wh.mart_neighbourhood_pressure, wh.mart_host_profile
    assert dashboard.capture_kpis(city, place).first().total_listings == 3
    assert dashboard.capture_kpis(city, place, "Málaga").first().total_listings == 2
    nothing = dashboard.capture_kpis(city, place, "Girona").first()
    assert tuple(nothing) == (0, 0.0, 0.0, 0)
    assert tuple(dashboard.host_kpis(host, "Girona").first()) == (0, 0.0, 0.0, 0.0)
    money = dashboard.money_kpis(city, host, "Sevilla").first()
    assert money.median_price == 100.0 and money.avg_professional_revenue is None
    assert dashboard.neighbourhood_scatter(place, 2).count() == 1
    shown = dashboard.city_table_display(dashboard.city_table(city)).first()
    assert (shown.ciudad, shown.pct_entire_home, shown.median_price_winsorized) == ("Málaga", "100.0%", "$100")


def test_reviews_series(spark):
    monthly = spark.createDataFrame(
        [("sevilla", 2014, 5), ("sevilla", 2015, 5), ("sevilla", 2015, 6), ("malaga", 2016, 3), ("girona", 2016, 1)],
        "city string, review_year int, total_reviews bigint",
    )
    by_year = dashboard.reviews_by_year(monthly)
    assert sorted(map(tuple, by_year.collect())) == [(2015, "Sevilla", 11), (2016, "Girona", 1), (2016, "Málaga", 3)]
    assert sorted(map(tuple, dashboard.reviews_national(by_year).collect())) == [(2015, 11), (2016, 4)]
    top = dashboard.reviews_top_cities(by_year, 2)
    assert {r.ciudad for r in top.select(F.col("ciudad")).collect()} == {"Sevilla", "Málaga"}
    assert [r.ciudad for r in dashboard.reviews_stacked(by_year).collect()] == ["Sevilla", "Málaga", "Girona"]
