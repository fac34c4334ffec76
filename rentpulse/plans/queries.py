"""Every operator and table as a named query over the test tables.

Each query takes (spark, sf_dir), reads the whole tables and returns a DataFrame.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.functions import cleanse as C
from rentpulse.functions import dates as D
from rentpulse.functions import labels as L
from rentpulse.functions.keys import surrogate_key
from rentpulse.functions.numeric import safe_divide
from rentpulse.operators import dedup, percentile, quality, scd2, sketches, winsorize
from rentpulse.plans import amenities, checks, dashboard, dims, facts, marts, silver
from rentpulse.plans.warehouse import SCD2_CHECK_COLUMNS, SCD2_KEY, PublishedWarehouse, Warehouse
from rentpulse.rules import RentalRules
from rentpulse.sources import buckets, carrier, change_log, extracts, manifest, tables
from rentpulse.sources.scratch import materialize, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

RULES = RentalRules(as_of=carrier.AS_OF)
FIRST_SNAPSHOT = dt.date(2026, 3, 31)
SECOND_SNAPSHOT = dt.date(2026, 7, 2)
THIRD_SNAPSHOT = dt.date(2026, 8, 15)
LISTING_BUCKETS = 16

_c = F.col
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison with another engine."""
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(_c(c), digits).alias(c) if c in doubles else _c(c) for c in df.columns])


def placed(df: DataFrame) -> DataFrame:
    """Adds the place of each row in the order the frame has; for results of a few rows."""
    numbered = df.withColumn("place", F.monotonically_increasing_id())
    return numbered.withColumn("place", F.row_number().over(Window.orderBy("place")))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carrier.raw_listings(spark, sf_dir)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw listings as a table with all their columns, because five gold tables read it."""
    return materialize(_raw(spark, sf_dir), "bronze")


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(_bronze(spark, sf_dir), carrier.raw_reviews(spark, sf_dir), RULES)


# Scalar expressions


@query
def expr_try_cast(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        C.try_long("id").alias("listing_id"),
        C.try_long("minimum_nights").alias("minimum_nights"),
        C.try_long("availability_365").alias("availability_365"),
        C.try_long("host_since").alias("not_a_number"),
        C.try_double("bathrooms").alias("bathrooms"),
        C.try_double("latitude").alias("latitude"),
        C.try_double("price").alias("not_a_double"),
    )


@query
def expr_currency(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", C.currency("price").alias("price_numeric"))


@query
def expr_percent(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "id",
        C.percent("host_response_rate").alias("response_rate"),
        C.percent("host_acceptance_rate").alias("acceptance_rate"),
    )


@query
def expr_bool_flag(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "id",
        C.flag("has_availability").alias("has_availability"),
        C.flag("host_is_superhost").alias("is_superhost"),
        C.equals_flag("room_type", R.ENTIRE_HOME).alias("is_entire_home"),
    )


@query
def expr_threshold_flag(spark, sf_dir):
    days = C.try_long("availability_365")
    return _raw(spark, sf_dir).select(
        "id",
        C.above_flag(days, RULES.high_availability_days).alias("is_high_availability"),
        C.above_flag(C.try_long("calculated_host_listings_count"), 1).alias("is_multihost"),
    )


@query
def expr_bucket_availability(spark, sf_dir):
    days = C.try_long("availability_365")
    return _raw(spark, sf_dir).select("id", silver.availability_profile(days, RULES).alias("availability_profile"))


@query
def expr_bucket_host(spark, sf_dir):
    homes = C.try_long("calculated_host_listings_count_entire_homes")
    return _raw(spark, sf_dir).select("id", silver.host_profile(homes, RULES).alias("host_profile"))


@query
def expr_is_active(spark, sf_dir):
    active = facts.is_active(
        C.currency("price"),
        C.try_long("availability_365"),
        C.try_long("number_of_reviews_ltm"),
        D.try_date("last_review"),
        RULES,
    )
    return _raw(spark, sf_dir).select("id", active.alias("is_active_listing"))


@query
def expr_trim(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", F.trim("neighbourhood_cleansed").alias("neighbourhood_cleansed"))


@query
def expr_try_date(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "id",
        D.try_date("host_since").alias("host_since"),
        D.try_date("last_scraped").alias("last_scraped"),
        D.try_date("last_review").alias("last_review"),
    )


@query
def expr_years_since(spark, sf_dir):
    since = D.try_date("host_since")
    return _raw(spark, sf_dir).select("id", D.years_between(since, RULES.today).alias("seniority_years"))


@query
def expr_days_since(spark, sf_dir):
    last = D.try_date("last_review")
    return _raw(spark, sf_dir).select("id", D.days_between(last, RULES.today).alias("days_since"))


@query
def expr_date_parts(spark, sf_dir):
    day = D.try_date("date")
    return carrier.raw_reviews(spark, sf_dir).select(
        "id",
        F.year(day).alias("review_year"),
        F.month(day).alias("review_month"),
        D.month_start(day).alias("review_month_start"),
    )


@query
def expr_safe_divide(spark, sf_dir):
    per_person = safe_divide(C.currency("price"), C.try_long("accommodates"))
    return rounded(_raw(spark, sf_dir).select("id", per_person.alias("price_per_person")))


# Ingestion


@query
def src_schema_align(spark, sf_dir):
    shuffled = _raw(spark, sf_dir).drop("license", "city").withColumn("unknown_extra", F.lit("x"))
    reordered = shuffled.select(*sorted(shuffled.columns))
    return extracts.align_schema(reordered, extracts.LISTING_COLUMNS)


@query
def src_null_tokens(spark, sf_dir):
    columns = _raw(spark, sf_dir).select("id", "price", "availability_365", "host_response_rate", "host_since")
    return extracts.replace_null_tokens(columns, extracts.LISTING_NULL_TOKENS)


@query
def src_tag_group(spark, sf_dir):
    return extracts.tag_group(_raw(spark, sf_dir).select("id", "price"), "city", "madrid")


@query
def src_csv_listings(spark, sf_dir):
    """All cities' listings written as gzipped CSV and loaded again, columns by name."""
    root = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    out = _raw(spark, sf_dir).select("price", "amenities", "id", "host_since", "name", F.lit("x").alias("extra"), "city")
    out.write.partitionBy("city").options(header=True, escape='"', compression="gzip", emptyValue="").csv(f"{root}/in")
    cities = [row.city for row in out.select("city").distinct().collect()]  # one folder each
    extracts.load_listings(spark, {city: f"{root}/in/city={city}" for city in cities}, f"{root}/bronze")
    loaded = tables.read_table(spark, f"{root}/bronze", extracts.text_schema([*extracts.LISTING_COLUMNS, "city"]))
    return loaded.select("id", "name", "amenities", "price", "host_since", "license", "city")


@query
def src_csv_reviews(spark, sf_dir):
    """One city's reviews written as gzipped CSV with other headers and loaded again, columns by position."""
    root = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows = carrier.raw_reviews(spark, sf_dir).filter(_c("city") == "madrid").select(*extracts.REVIEW_COLUMNS)
    renamed = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    renamed.write.options(header=True, escape='"', compression="gzip", emptyValue="").csv(f"{root}/in")
    extracts.load_reviews(spark, {"madrid": f"{root}/in"}, f"{root}/bronze")
    return tables.read_table(spark, f"{root}/bronze", extracts.text_schema([*extracts.REVIEW_COLUMNS, "city"]))


@query
def src_csv_reviews_all(spark, sf_dir):
    """All cities' reviews written as gzipped CSV with other headers and loaded again in one scan, by position."""
    root = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows = materialize(carrier.raw_reviews(spark, sf_dir), "reviews")
    renamed = rows.toDF(*[f"c{i}" for i in range(len(extracts.REVIEW_COLUMNS))], "city")
    renamed.write.partitionBy("city").options(header=True, escape='"', compression="gzip", emptyValue="").csv(f"{root}/in")
    cities = [row.city for row in rows.select("city").distinct().collect()]  # one folder each
    extracts.load_reviews(spark, {city: f"{root}/in/city={city}" for city in cities}, f"{root}/bronze")
    return tables.read_table(spark, f"{root}/bronze", extracts.text_schema([*extracts.REVIEW_COLUMNS, "city"]))


@query
def src_bad_rows(spark, sf_dir):
    """All cities' listings from files in which some rows have a field too many or too few: loaded and set aside."""
    root = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    number = C.try_long("id")
    whole = F.concat("id", F.lit(',"'), "name", F.lit('",'), F.coalesce("availability_365", F.lit("")))
    line = F.when(number % 41 == 0, _c("id")).when(number % 37 == 0, F.concat(whole, F.lit(",surplus"))).otherwise(whole)
    rows = materialize(_raw(spark, sf_dir).select(line.alias("id,name,availability_365"), "city"), "lines")
    plain = {"header": True, "sep": "\u0001", "quote": "\u0002", "compression": "gzip"}  # the line as it is
    rows.write.partitionBy("city").options(**plain).csv(f"{root}/in")
    cities = [row.city for row in rows.select("city").distinct().collect()]  # one folder each
    files = {city: f"{root}/in/city={city}" for city in cities}
    extracts.load_listings(spark, files, f"{root}/bronze", quarantine=f"{root}/quarantine")
    loaded = tables.read_table(spark, f"{root}/bronze", extracts.text_schema([*extracts.LISTING_COLUMNS, "city"]))
    aside = tables.read_table(spark, f"{root}/quarantine", extracts.text_schema(["file", "row", "city"]))
    return loaded.select("city", "id", "name", "availability_365").unionByName(aside.drop("file"), allowMissingColumns=True)


@query
def src_table_versions(spark, sf_dir):
    """A table published twice, as its readers find it: the reviews by month, then those since 2015 only."""
    base = f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}"
    monthly = _warehouse_reviews(spark, sf_dir)
    tables.publish_version(monthly, base)
    tables.publish_version(monthly.filter("review_year >= 2015"), base)
    return tables.latest_version(spark, base)


def _exported(spark: SparkSession, sf_dir: str, root: str) -> list[tables.ExportResult]:
    location = silver.stg_location(_raw(spark, sf_dir))
    places = dims.dim_neighbourhood(location)
    shouted = places.toDF(*[c.upper() for c in places.columns])
    return tables.export_tables({"places": shouted, "reviews": fact_reviews_monthly(spark, sf_dir)}, root)


@query
def src_export_fold(spark, sf_dir):
    """A table with upper-case columns after its export."""
    root = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    _exported(spark, sf_dir, root)
    return tables.read_table(spark, f"{root}/places.parquet")


@query
def src_export_summary(spark, sf_dir):
    summary = tables.export_summary(_exported(spark, sf_dir, f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"))
    row = (summary["tables"], summary["rows"], summary["megabytes"] > 0)
    return spark.createDataFrame([row], "tables bigint, n_rows bigint, has_size boolean")


@query
def expr_format(spark, sf_dir):
    """Counts, percentages and amounts as the dashboard shows them."""
    orders = carrier.orders(spark, sf_dir)
    return orders.select(
        _c("k").alias("id"),
        L.format_count(_c("k") * 1000 + 7).alias("shown_count"),
        L.format_pct(_c("k") % 4001 / 40).alias("shown_pct"),
        L.format_money(_c("k") * 7 / 2).alias("shown_money"),
    )


@query
def src_group_reload(spark, sf_dir):
    """Load all cities, then reload two of them with only their priced listings."""
    rows = _raw(spark, sf_dir).select("id", "price", "city")
    path = f"{shared_dir(spark)}/reload-{uuid.uuid4().hex}"
    tables.append_rows(rows, path, ["city"])
    tables.reload_group(rows.filter(_c("price").isNotNull()), path, "city", ["madrid", "mallorca"])
    return tables.read_table(spark, path, rows.schema)


@query
def val_group_counts(spark, sf_dir):
    return placed(tables.group_counts(_raw(spark, sf_dir), "city"))


@query
def val_null_by_group(spark, sf_dir):
    return placed(tables.null_counts_by_group(_raw(spark, sf_dir), "city", "room_type"))


# Silver


@query
def stg_details(spark, sf_dir):
    return rounded(silver.stg_details(_raw(spark, sf_dir)))


@query
def stg_host(spark, sf_dir):
    return rounded(silver.stg_host(_raw(spark, sf_dir), RULES))


@query
def stg_location(spark, sf_dir):
    return rounded(silver.stg_location(_raw(spark, sf_dir)))


@query
def stg_availability(spark, sf_dir):
    return rounded(silver.stg_availability(_raw(spark, sf_dir), RULES))


@query
def stg_reviews_scores(spark, sf_dir):
    return rounded(silver.stg_review_scores(_raw(spark, sf_dir), RULES))


@query
def stg_reviews(spark, sf_dir):
    return silver.stg_reviews(carrier.raw_reviews(spark, sf_dir))


# Statistics


@query
def winsorize_p95(spark, sf_dir):
    lines = carrier.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    return rounded(winsorize.winsorize(lines, "l_extendedprice", ["l_returnflag"], 0.95, "price_winsorized"))


@query
def agg_percentile(spark, sf_dir):
    lines = carrier.read_table(spark, sf_dir, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    return rounded(percentile.group_percentile(lines, keys, "l_extendedprice", 0.95, "p95_price"))


@query
def agg_composite_score(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    typed = raw.select(
        "city",
        F.trim("neighbourhood_cleansed").alias("neighbourhood_cleansed"),
        C.equals_flag("room_type", R.ENTIRE_HOME).alias("is_entire_home"),
        C.above_flag(C.try_long("availability_365"), RULES.high_availability_days).alias("is_high_availability"),
        silver.host_profile(C.try_long("calculated_host_listings_count_entire_homes"), RULES).alias(
            "host_profile"
        ),
    )
    scored = typed.groupBy("neighbourhood_cleansed", "city").agg(marts.pressure_score(RULES).alias("score"))
    return rounded(scored, 2)


@query
def agg_distinct_sketch(spark, sf_dir):
    """Reviewers per city and year from monthly sketches, held against the exact count."""
    reviews = materialize(silver.stg_reviews(carrier.raw_reviews(spark, sf_dir)).select("city", "review_year", "review_month", "reviewer_id"), "reviews")
    monthly = sketches.distinct_sketches(reviews, ["city", "review_year", "review_month"], "reviewer_id", "sketch")
    yearly = sketches.roll_up_distinct(materialize(monthly, "sketches"), ["city", "review_year"], "sketch")
    exact = reviews.groupBy("city", "review_year").agg(F.countDistinct("reviewer_id").alias("reviewers"))
    both = exact.join(
        yearly.withColumnsRenamed({"city": "c", "review_year": "y"}),
        exact["city"].eqNullSafe(_c("c")) & exact["review_year"].eqNullSafe(_c("y")),
    )
    near = F.abs(sketches.distinct_estimate("sketch") - _c("reviewers")) <= _c("reviewers") * sketches.distinct_error()
    return both.select("city", "review_year", "reviewers", near.alias("within_bound"))


@query
def agg_quantile_sketch(spark, sf_dir):
    """P95 of prices from sketches per group and part, merged per group; its rank held against the rows."""
    lines = carrier.read_table(spark, sf_dir, "lineitem").withColumn("part", _c("l_linenumber"))
    keys = ["l_returnflag", "l_linestatus"]
    parts = sketches.quantile_sketches(lines, [*keys, "part"], "l_extendedprice", "sketch")
    merged = sketches.roll_up_quantiles(materialize(parts, "sketches"), keys, "sketch")
    p95 = materialize(merged.select(*keys, sketches.quantile_estimate("sketch", 0.95).alias("p95")), "p95")
    ranked = lines.join(p95, keys).groupBy(*keys).agg(
        F.count("l_extendedprice").alias("n"),
        F.count_if(_c("l_extendedprice") < _c("p95")).alias("below"),
        F.count_if(_c("l_extendedprice") <= _c("p95")).alias("upto"),
    )
    slack = sketches.quantile_rank_error()
    near = (_c("below") <= _c("n") * (0.95 + slack)) & (_c("upto") >= _c("n") * (0.95 - slack))
    return ranked.select(*keys, "n", near.alias("within_bound"))


# Keys, dimensions, joins


@query
def dim_surrogate_key(spark, sf_dir):
    host = silver.stg_host(_raw(spark, sf_dir), RULES)
    return host.select(
        "listing_id",
        surrogate_key(_c("host_id"), _c("city")).alias("host_sk"),
        surrogate_key(_c("host_since"), _c("city")).alias("key_with_null"),
    )


@query
def dim_neighbourhood(spark, sf_dir):
    return dims.dim_neighbourhood(silver.stg_location(_raw(spark, sf_dir)))


@query
def dim_listing(spark, sf_dir):
    warehouse = Warehouse(_raw(spark, sf_dir), carrier.raw_reviews(spark, sf_dir), RULES)
    return rounded(dims.dim_listing(warehouse.wide))


@query
def dim_host(spark, sf_dir):
    return dims.dim_host(silver.stg_host(_raw(spark, sf_dir), RULES), RULES)


@query
def seed_lookup_join(spark, sf_dir):
    details = silver.stg_details(_raw(spark, sf_dir)).select("listing_id", "room_type")
    return dims.with_room_type_id(details).select("listing_id", "room_type", "room_type_id")


@query
def join_left_single(spark, sf_dir):
    columns = ["listing_id", "city", "snapshot_date", "neighbourhood_cleansed"]
    return _warehouse(spark, sf_dir).window_listings.select(*columns)


@query
def join_copartitioned(spark, sf_dir):
    """Fact and listing dimension stored by listing, joined without moving either."""
    warehouse = _warehouse(spark, sf_dir)
    fact = buckets.write_bucketed(warehouse.fact_listings, "fact_listings", "listing_id", LISTING_BUCKETS)
    listings = buckets.write_bucketed(warehouse.dim_listing, "dim_listing", "listing_id", LISTING_BUCKETS)
    places = listings.select("listing_id", "neighbourhood_cleansed").hint("merge")
    met = fact.join(places, "listing_id", "left")
    return rounded(met.select("listing_id", "city", "snapshot_date", "neighbourhood_cleansed", "price_winsorized"))


@query
def join_label_table(spark, sf_dir):
    """Host names looked up in a table of labels, one per customer."""
    names = carrier.read_table(spark, sf_dir, "customer").selectExpr("string(c_custkey) AS host_id", "c_name AS label")
    listings = _raw(spark, sf_dir).select("id", "host_id")
    return L.join_labels(listings, materialize(names, "labels"), "host_id", "host_label")


def _offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with amenities texts that differ: JSON arrays, broken JSON, other JSON, none."""
    number = C.try_long("id")
    items = F.array_compact(
        F.array(
            F.lit('"Wifi"'),
            F.when(number % 2 == 0, F.lit('"Kitchen"')),
            F.when(number % 3 == 0, F.lit('" Caf\\u00e9, \\"bar\\" "')),
            F.when(number % 5 == 0, F.lit("null")),
            F.when(number % 7 == 0, F.lit('"Wifi"')),
            F.when(number % 11 == 0, F.lit('""')),
        )
    )
    text = (
        F.when(number % 13 == 0, F.lit('["Wifi", "Kit'))
        .when(number % 17 == 0, F.lit('{"Wifi": 1}'))
        .when(number % 19 == 0, F.lit(None))
        .when(number % 23 == 0, F.lit("[]"))
        .otherwise(F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))
    )
    return _raw(spark, sf_dir).select(number.alias("listing_id"), "city", text.alias("amenities"))


@query
def stg_amenities(spark, sf_dir):
    return amenities.listing_amenities(_offered(spark, sf_dir))


@query
def mart_amenities(spark, sf_dir):
    offered = materialize(_offered(spark, sf_dir), "offered")
    return amenities.amenity_shares(amenities.listing_amenities(offered), offered)


@query
def join_left_composite(spark, sf_dir):
    location = silver.stg_location(_raw(spark, sf_dir))
    keyed = location.join(dims.dim_neighbourhood(location), ["neighbourhood_cleansed", "city"], "left")
    return keyed.select("listing_id", "city", "neighbourhood_id")


@query
def dedup_host(spark, sf_dir):
    host = silver.stg_host(_raw(spark, sf_dir), RULES)
    columns = ["host_id", "city", "host_name", "calculated_host_listings_count", "host_profile"]
    return dims.dedup_host(host.select(*columns))


@query
def dedup_listing(spark, sf_dir):
    rows = _raw(spark, sf_dir).select(
        C.try_long("id").alias("listing_id"), D.try_date("last_scraped").alias("snapshot_date"), "city"
    )
    return dedup.keep_first(rows, ["listing_id"], [F.desc_nulls_last("snapshot_date"), F.asc("city")])


# Facts and incremental loading


@query
def fact_star(spark, sf_dir):
    warehouse = _warehouse(spark, sf_dir)
    return rounded(facts.fact_listings(warehouse.wide, warehouse.dim_host, RULES))


@query
def fact_reviews_monthly(spark, sf_dir):
    return facts.fact_reviews_monthly(silver.stg_reviews(carrier.raw_reviews(spark, sf_dir)))


@query
def latest_window(spark, sf_dir):
    rows = _raw(spark, sf_dir).select(
        C.try_long("id").alias("listing_id"), D.try_date("last_scraped").alias("snapshot_date"), "city"
    )
    return dedup.latest_window(rows, "city", "listing_id", "snapshot_date", RULES.window_days)


def _loads(spark: SparkSession, sf_dir: str, *, both: bool) -> DataFrame:
    """The stored fact after a load without one city, and after a second load of all cities."""
    root = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    raw, reviews = _bronze(spark, sf_dir), carrier.raw_reviews(spark, sf_dir)
    first = PublishedWarehouse(root, raw.filter(_c("city") != "mallorca"), reviews, RULES).fact_listings
    return rounded(PublishedWarehouse(root, raw, reviews, RULES).fact_listings if both else first)


@query
def incr_first_load(spark, sf_dir):
    return _loads(spark, sf_dir, both=False)


@query
def incr_new_partitions(spark, sf_dir):
    return _loads(spark, sf_dir, both=True)


@query
def incr_old_version(spark, sf_dir):
    """The version before the newest, as a reader that began with it still finds it after the second load."""
    root = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    raw, reviews = _bronze(spark, sf_dir), carrier.raw_reviews(spark, sf_dir)
    first = PublishedWarehouse(root, raw.filter(_c("city") != "mallorca"), reviews, RULES).fact_listings
    second = PublishedWarehouse(root, raw, reviews, RULES).fact_listings
    path = f"{root}/fact_listings"
    before = manifest.versions(spark, path)[-2]
    return rounded(manifest.read_live(spark, path, first.schema, facts.FACT_PARTITIONS, before).select(*second.columns))


# Type-2 history


def _first_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = carrier.first_snapshot_orders(spark, sf_dir)
    host = silver.stg_host(carrier.raw_listings_from(spark, sf_dir, orders), RULES)
    return scd2.scd2_first_load(dims.dim_host(host, RULES), FIRST_SNAPSHOT)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = carrier.second_snapshot_orders(spark, sf_dir)
    host = silver.stg_host(carrier.raw_listings_from(spark, sf_dir, orders), RULES)
    stored = materialize(_first_history(spark, sf_dir), "history")
    return scd2.scd2_apply(stored, dims.dim_host(host, RULES), SCD2_KEY, SCD2_CHECK_COLUMNS, SECOND_SNAPSHOT)


@query
def scd2_first_load(spark, sf_dir):
    return _first_history(spark, sf_dir)


@query
def scd2_apply(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scd2_current(spark, sf_dir):
    return scd2.scd2_current(_history(spark, sf_dir))


@query
def scd2_as_of(spark, sf_dir):
    return scd2.scd2_as_of(_history(spark, sf_dir), dt.date(2026, 5, 1))


@query
def scd2_changed(spark, sf_dir):
    history = materialize(_history(spark, sf_dir), "history")
    return scd2.scd2_changed(history, SCD2_KEY, SCD2_CHECK_COLUMNS)


def _later_state(hosts: DataFrame) -> DataFrame:
    """All hosts as a later snapshot has them: some with one listing more, some turned professional, some gone.

    Which host does what follows from its id; ``vanished`` is a column of the state.
    """
    more = F.when(_c("host_id") % 7 == 0, _c("calculated_host_listings_count") + 1)
    profile = F.when(_c("host_id") % 21 == 0, F.lit(R.PROFESSIONAL_HOST))
    return hosts.withColumns(
        {
            "calculated_host_listings_count": F.coalesce(more, "calculated_host_listings_count"),
            "host_profile": F.coalesce(profile, "host_profile"),
            "vanished": _c("host_id") % 50 == 0,
        }
    )


def _logged_history(spark: SparkSession, sf_dir: str) -> change_log.ChangeLog:
    """Three runs over all hosts: as they are, in a later state, as they are again; a checkpoint after the second."""
    hosts = materialize(dims.dim_host(silver.stg_host(_raw(spark, sf_dir), RULES), RULES), "hosts")
    later = _later_state(hosts).filter(~_c("vanished")).drop("vanished")
    step = scd2.scd2_first_load(hosts, FIRST_SNAPSHOT)
    base = f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
    log = change_log.ChangeLog(spark, base, SCD2_KEY, step.schema, every=2)
    log.append(step)
    for state, day in ((later, SECOND_SNAPSHOT), (hosts, THIRD_SNAPSHOT)):
        log.append(scd2.scd2_step(log.open_versions(), state, SCD2_KEY, SCD2_CHECK_COLUMNS, day, changes_only=True))
    return log


@query
def scd2_log_history(spark, sf_dir):
    """The stored history of all hosts, from a checkpoint and the changes after it."""
    return _logged_history(spark, sf_dir).history()


@query
def scd2_log_open(spark, sf_dir):
    return _logged_history(spark, sf_dir).open_versions()


@query
def scd2_log_as_of(spark, sf_dir):
    return scd2.scd2_as_of(_logged_history(spark, sf_dir).history(), dt.date(2026, 7, 20))


@query
def scd2_log_changed(spark, sf_dir):
    history = materialize(_logged_history(spark, sf_dir).history(), "history")
    return scd2.scd2_changed(history, SCD2_KEY, SCD2_CHECK_COLUMNS)


# Marts


@query
def mart_neighbourhood(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_neighbourhood_pressure


@query
def mart_host(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_host_profile


@query
def mart_city(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_city_comparison


@query
def export_listings_dashboard(spark, sf_dir):
    return rounded(_warehouse(spark, sf_dir).listings_extract)


# Quality


@query
def dq_not_null(spark, sf_dir):
    return checks.check_not_null(_warehouse(spark, sf_dir).table)


@query
def dq_unique(spark, sf_dir):
    """The uniqueness rules of the gold tables, and one column that does repeat."""
    warehouse = _warehouse(spark, sf_dir)
    repeated = quality.unique(warehouse.dim_host.select(_c("host_id").cast("string").alias("value")), "value")
    shown = repeated.select(F.lit("dim_host").alias("table_name"), F.lit("host_id").alias("column_name"), "*")
    return checks.check_unique(warehouse.table).unionByName(shown)


@query
def dq_unique_combo(spark, sf_dir):
    return checks.check_unique_combinations(_warehouse(spark, sf_dir).table)


@query
def dq_accepted_values(spark, sf_dir):
    return checks.check_accepted_values(_warehouse(spark, sf_dir).table, RULES)


@query
def dq_relationships(spark, sf_dir):
    """The foreign-key rules of the fact, and the keys that a one-city dimension would orphan."""
    warehouse = _warehouse(spark, sf_dir)
    one_city = warehouse.dim_neighbourhood.filter(_c("city") == "madrid")
    orphaned = quality.relationships(warehouse.fact_listings, "neighbourhood_id", one_city, "neighbourhood_id")
    shown = orphaned.select(
        F.lit("fact_listings").alias("table_name"), F.lit("neighbourhood_id in madrid").alias("column_name"), "*"
    )
    return checks.check_relationships(warehouse.table).unionByName(shown)


@query
def dq_marts_consistency(spark, sf_dir):
    return _warehouse(spark, sf_dir).marts_consistency()


@query
def dq_marts_regression(spark, sf_dir):
    """The consistency check on marts built from each city's exact latest date only."""
    warehouse = _warehouse(spark, sf_dir)
    narrow = RentalRules(as_of=RULES.as_of, window_days=0)
    sliver = materialize(
        marts.window_listings(warehouse.fact_listings, warehouse.dim_listing, narrow), "sliver"
    )
    return checks.check_marts_consistency(
        warehouse.fact_listings,
        warehouse.dim_listing,
        marts.mart_city_comparison(sliver, warehouse.dim_host),
        marts.mart_neighbourhood_pressure(sliver, RULES),
        marts.mart_host_profile(warehouse.dim_host, sliver),
        RULES,
    )


@query
def dq_revenue_coverage(spark, sf_dir):
    """Cities below a floor of 90 % of hosts with revenue (the usual floor of 40 % holds)."""
    strict = RentalRules(as_of=RULES.as_of, min_revenue_coverage_pct=90.0)
    return checks.check_revenue_coverage(_warehouse(spark, sf_dir).mart_host_profile, strict)


# Dashboard


def _reviews_by_year(spark: SparkSession, sf_dir: str, city: str | None = None) -> DataFrame:
    return dashboard.reviews_by_year(_warehouse_reviews(spark, sf_dir), city)


def _warehouse_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly reviews fact as a table, which the yearly series read more than once."""
    return materialize(fact_reviews_monthly(spark, sf_dir), "fact_reviews_monthly")


@query
def dash_city_label(spark, sf_dir):
    cities = _raw(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    return dashboard.with_city_label(cities)


@query
def dash_kpis_capture(spark, sf_dir):
    warehouse = _warehouse(spark, sf_dir)
    return rounded(
        dashboard.capture_kpis(warehouse.mart_city_comparison, warehouse.mart_neighbourhood_pressure), 2
    )


@query
def dash_neighbourhood_scatter(spark, sf_dir):
    return dashboard.neighbourhood_scatter(_warehouse(spark, sf_dir).mart_neighbourhood_pressure)


@query
def dash_reviews_by_year(spark, sf_dir):
    return _reviews_by_year(spark, sf_dir)


@query
def dash_reviews_one_city(spark, sf_dir):
    return _reviews_by_year(spark, sf_dir, "Madrid")


@query
def dash_reviews_national(spark, sf_dir):
    return dashboard.reviews_national(_reviews_by_year(spark, sf_dir))


@query
def dash_reviews_top5(spark, sf_dir):
    """The series of the five strongest cities."""
    return dashboard.reviews_top_cities(_reviews_by_year(spark, sf_dir), 5)


@query
def dash_reviews_stacked(spark, sf_dir):
    return placed(dashboard.reviews_stacked(_reviews_by_year(spark, sf_dir)))


@query
def dash_host_kpis(spark, sf_dir):
    return rounded(dashboard.host_kpis(_warehouse(spark, sf_dir).mart_host_profile), 2)


@query
def dash_hosts_by_profile(spark, sf_dir):
    return dashboard.hosts_by_profile(_warehouse(spark, sf_dir).mart_host_profile)


@query
def dash_listings_by_profile(spark, sf_dir):
    return dashboard.listings_by_profile(_warehouse(spark, sf_dir).mart_host_profile)


@query
def dash_profile_pivot(spark, sf_dir):
    return dashboard.listings_by_profile_wide(_warehouse(spark, sf_dir).mart_host_profile)


@query
def dash_kpis_money(spark, sf_dir):
    warehouse = _warehouse(spark, sf_dir)
    return rounded(dashboard.money_kpis(warehouse.mart_city_comparison, warehouse.mart_host_profile), 2)


@query
def dash_top_neighbourhoods(spark, sf_dir):
    return dashboard.top_neighbourhoods(_warehouse(spark, sf_dir).mart_neighbourhood_pressure)


@query
def dash_city_table(spark, sf_dir):
    return placed(dashboard.city_table(_warehouse(spark, sf_dir).mart_city_comparison))


@query
def dash_top_hosts(spark, sf_dir):
    return placed(dashboard.top_hosts(_warehouse(spark, sf_dir).mart_host_profile))
