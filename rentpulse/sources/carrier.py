"""Text-typed rental extracts derived from the star-schema test tables.

An order carries a listing, its customer the host, the nation the neighbourhood and the region
the city; a line item carries a review. The derivation is deterministic and injects what the
cleansing has to survive: currency and percent text, bad dates, empty and missing fields,
padding, unknown room types, several scrape dates per snapshot, an older snapshot, re-scraped
listings, double-loaded rows and listings delivered by two cities.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentpulse.sources.extracts import LISTING_COLUMNS, REVIEW_COLUMNS

AS_OF = dt.date(2026, 7, 15)

# Regions 1 to 4 stand for these cities, any other keeps its own name.
_CITY = (
    "CASE r_regionkey WHEN 1 THEN 'madrid' WHEN 2 THEN 'malaga' WHEN 3 THEN 'mallorca' "
    "WHEN 4 THEN 'sevilla' ELSE lower(r_name) END"
)


def _text(number: str) -> str:
    return f"string({number})"


def _tenth(number: str, modulus: int) -> str:
    """A score between 3.0 and 5.0 as text."""
    return f"concat(string({number} % {modulus} div 10 + 3), '.', string({number} % {modulus} % 10))"


def _tfn(number: str) -> str:
    """``t``, ``f`` or NULL in turn."""
    return f"CASE ({number}) % 3 WHEN 0 THEN 't' WHEN 1 THEN 'f' END"


def _day(start: str, offset: str) -> str:
    return f"string(date_add(date '{start}', int({offset})))"


def _reviewed(text: str) -> str:
    return f"CASE WHEN k % 8 != 0 THEN {text} END"


def _counted(name: str) -> str:
    return f"CASE WHEN k % 19 != 0 THEN string({name}) END"


_MONEY = "concat('$', format_number(o_totalprice, 2))"
_SCORES = {
    "accuracy": 20,
    "cleanliness": 19,
    "checkin": 18,
    "communication": 17,
    "location": 16,
    "value": 15,
}

_LISTING = {
    "id": _text("k"),
    "last_scraped": _day(
        "2026-06-20", "k % 13 - if(k % 5 = 0, 91, 0) - if(copy = 'rescrape', 7, 0)"
    ),
    "name": "concat('Listing ', k)",
    "host_id": _text("o_custkey"),
    "host_name": "c_name",
    "host_since": f"if(o_custkey % 60 = 0, 'unknown', {_day('2008-01-01', 'o_custkey * 17 % 6000')})",
    "host_response_time": "'within an hour'",
    "host_response_rate": "if(k % 13 = 0, 'N/A', concat(k % 101, '%'))",
    "host_acceptance_rate": "if(k % 17 != 0, concat(k % 89, '%'), NULL)",
    "host_is_superhost": _tfn("o_custkey"),
    "host_has_profile_pic": _tfn("o_custkey + 1"),
    "host_identity_verified": _tfn("o_custkey + 2"),
    "neighbourhood_cleansed": (
        "CASE WHEN k % 509 = 0 THEN NULL WHEN k % 40 = 0 THEN 'no asignado' "
        "ELSE concat(' ', n_name, '/', if(k % 3 = 0, 0, k % 8), if(k % 7 = 0, ' ', '')) END"
    ),
    "latitude": "concat('36.', lpad(string(k % 1000), 3, '0'))",
    "longitude": "concat('-', k % 6, '.', lpad(string(k * 7 % 1000), 3, '0'))",
    "property_type": "if(k % 2 = 0, 'Entire rental unit', 'Private room in home')",
    "room_type": (
        "CASE WHEN k % 997 = 0 THEN NULL WHEN k % 499 = 0 THEN 'Tent' WHEN kind IN ('1', '2') THEN 'Entire home/apt' "
        "WHEN kind = '3' THEN 'Private room' WHEN kind = '4' THEN 'Hotel room' ELSE 'Shared room' END"
    ),
    "accommodates": _text("k % 9"),
    "bathrooms": "concat(k % 5, '.5')",
    "bathrooms_text": "concat(k % 5, '.5 baths')",
    "bedrooms": _text("k % 6"),
    "beds": "if(k % 6 != 0, concat(k % 6, '.0'), NULL)",
    "amenities": """'["Wifi", "Kitchen"]'""",
    "price": f"CASE WHEN k % 11 = 0 THEN NULL WHEN k % 97 = 0 THEN 'N/A' ELSE {_MONEY} END",
    "minimum_nights": "if(k % 29 = 0, concat(k % 30, '.7'), string(k % 30))",
    "maximum_nights": _text("k % 10 + 365"),
    "has_availability": _tfn("k"),
    "availability_30": _text("k % 31"),
    "availability_60": _text("k % 61"),
    "availability_90": _text("k % 91"),
    "availability_365": "if(k % 31 = 0, '', string(k * 37 % 366))",
    "number_of_reviews": _text("k % 500"),
    "number_of_reviews_ltm": "if(k % 6 != 0, string(k % 5), NULL)",
    "number_of_reviews_l30d": _text("k % 3"),
    "number_of_reviews_ly": _text("k % 50"),
    "estimated_occupancy_l365d": _text("k * 53 % 256"),
    "estimated_revenue_l365d": f"if(k % 11 != 0, {_MONEY}, NULL)",
    "first_review": _reviewed(_day("2015-01-01", "k % 3000")),
    "last_review": _reviewed(_day("2026-07-01", "-(k % 900)")),
    "review_scores_rating": f"if(k % 10 != 0, {_tenth('k', 21)}, NULL)",
    **{f"review_scores_{name}": _reviewed(_tenth("k", modulus)) for name, modulus in _SCORES.items()},
    "license": "if(k % 4 != 0, concat('HUT-', k), NULL)",
    "instant_bookable": _tfn("k + 1"),
    "calculated_host_listings_count": _counted("n_all"),
    "calculated_host_listings_count_entire_homes": _counted("n_entire"),
    "calculated_host_listings_count_private_rooms": _counted("n_private"),
    "calculated_host_listings_count_shared_rooms": _counted("n_shared"),
    "reviews_per_month": _reviewed("concat(k % 7, '.', lpad(string(k % 100), 2, '0'))"),
    "city": "CASE WHEN copy != 'overlap' THEN city WHEN city = 'mallorca' THEN 'menorca' ELSE 'mallorca' END",
}
_COPIES = (
    "explode(array_compact(array('base', if(k % 17 = 0, 'rescrape', NULL), if(k % 101 = 0, 'double', NULL), "
    "if(k % 103 = 0, 'overlap', NULL)))) AS copy"
)


# The columns read from each test table; a given schema saves a footer-reading job per table.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation and city."""
    cities = read_table(spark, sf_dir, "region").selectExpr("r_regionkey AS n_regionkey", f"{_CITY} AS city")
    nations = read_table(spark, sf_dir, "nation").join(cities, "n_regionkey")
    nations = nations.selectExpr("n_nationkey AS c_nationkey", "n_name", "city")
    customers = read_table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_name", "c_nationkey")
    return customers.join(nations, "c_nationkey").drop("c_nationkey")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey", "substr(o_orderpriority, 1, 1) AS kind", "o_totalprice", "o_orderdate"
    )


def raw_listings_from(spark: SparkSession, sf_dir: str, some_orders: DataFrame) -> DataFrame:
    """The listings extract carried by the given orders."""
    counts = some_orders.groupBy("o_custkey").agg(
        F.expr("count(*) AS n_all"),
        F.expr("count_if(kind IN ('1', '2')) AS n_entire"),
        F.expr("count_if(kind = '3') AS n_private"),
        F.expr("count_if(kind = '5') AS n_shared"),
    )
    hosts = counts.join(_customer_places(spark, sf_dir), "o_custkey")
    rows = some_orders.join(hosts, "o_custkey").hint("rebalance").selectExpr("*", _COPIES)
    return rows.selectExpr(*[f"{_LISTING.get(c, 'cast(NULL AS string)')} AS {c}" for c in (*LISTING_COLUMNS, "city")])


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_listings_from(spark, sf_dir, orders(spark, sf_dir))


_REVIEW = {
    "listing_id": _text("k"),
    "id": _text("k * 10 + l_linenumber"),
    "date": "if((k + l_linenumber) % 50 = 0, '', string(add_months(date(l_shipdate), 216)))",
    "reviewer_id": _text("l_partkey"),
    "reviewer_name": "concat('Guest ', l_partkey)",
    "comments": "'Muy bien, todo perfecto'",
    # Reviews of overlapping listings come with the second city, so there is a sixth.
    "city": "CASE WHEN k % 103 != 0 THEN city WHEN city = 'mallorca' THEN 'menorca' ELSE 'mallorca' END",
}


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber", "l_partkey", "l_shipdate")
    places = _customer_places(spark, sf_dir).select("o_custkey", "city")
    order_city = orders(spark, sf_dir).select("k", "o_custkey").join(places, "o_custkey")
    columns = [f"{_REVIEW[c]} AS {c}" for c in (*REVIEW_COLUMNS, "city")]
    return lines.join(order_city, "k").hint("rebalance").selectExpr(*columns)


def first_snapshot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that an earlier snapshot had seen."""
    return orders(spark, sf_dir).filter("o_orderdate < timestamp_ntz '2000-01-01'")


def second_snapshot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders but those of vanished hosts."""
    return orders(spark, sf_dir).filter("o_custkey % 50 != 0")
