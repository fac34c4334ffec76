"""The quality rules of the rental tables and their evaluation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.operators import quality as Q
from rentpulse.rules import RentalRules

Tables = Callable[[str], DataFrame]
T = TypeVar("T")

# Columns that must not be NULL, per table.
NOT_NULL = {
    "stg_details": ["listing_id", "room_type", "city"],
    "stg_host": ["host_id", "listing_id", "host_profile"],
    "stg_location": ["listing_id", "neighbourhood_cleansed"],
    "stg_availability": ["listing_id"],
    "stg_review_scores": ["listing_id"],
    "stg_reviews": ["review_id", "listing_id"],
    "dim_neighbourhood": ["neighbourhood_id", "neighbourhood_cleansed", "city"],
    "dim_listing": ["listing_id", "is_entire_home"],
    "dim_host": ["host_sk", "host_id", "host_profile"],
    "fact_listings": ["is_active_listing", "snapshot_date"],
    "fact_reviews_monthly": ["total_reviews", "distinct_listings"],
    "mart_neighbourhood_pressure": ["neighbourhood_cleansed", "pressure_score"],
    "mart_host_profile": ["host_id", "host_profile"],
    "mart_city_comparison": ["city"],
}

# Columns without repeated values.
UNIQUE = [("dim_neighbourhood", "neighbourhood_id"), ("dim_host", "host_sk"), ("mart_city_comparison", "city")]

# Column combinations without repeats.
UNIQUE_COMBINATIONS = [
    ("stg_details", ["listing_id"]),
    ("stg_host", ["listing_id"]),
    ("stg_location", ["listing_id"]),
    ("stg_availability", ["listing_id"]),
    ("stg_review_scores", ["listing_id"]),
    ("fact_listings", ["listing_id", "snapshot_date"]),
]

# Views that are projections of the same rows; rules on them are evaluated on those rows, together.
SAME_ROWS = {
    "stg_details": "typed_listings",
    "stg_host": "typed_listings",
    "stg_location": "typed_listings",
    "stg_availability": "typed_listings",
    "stg_review_scores": "typed_listings",
}

# Foreign keys.
RELATIONSHIPS = [
    ("fact_listings", "neighbourhood_id", "dim_neighbourhood", "neighbourhood_id"),
    ("fact_listings", "host_sk", "dim_host", "host_sk"),
]


def accepted_value_rules(rules: RentalRules) -> list[tuple[str, str, list[str], str]]:
    """(table, column, domain, severity)."""
    room_types = [room_type for _, room_type, _, _ in R.ROOM_TYPES]
    return [
        ("stg_details", "room_type", room_types, "warn"),
        ("stg_details", "city", list(rules.cities), "error"),
        ("stg_host", "host_profile", list(R.HOST_PROFILES), "error"),
        ("stg_availability", "availability_profile", list(R.AVAILABILITY_PROFILES), "error"),
        ("dim_host", "host_profile", list(R.HOST_PROFILES), "error"),
    ]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _tagged(df: DataFrame, table: str, column: str) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "*")


def _shared(rules: list[tuple[str, T]]) -> dict[tuple[str, T], list[str]]:
    """Tables per (rows, rule): tables that show the same rows share a rule's evaluation."""
    found: dict[tuple[str, T], list[str]] = {}
    for table, rule in rules:
        found.setdefault((SAME_ROWS.get(table, table), rule), []).append(table)
    return found


def _for_tables(names: list[str]) -> Column:
    return F.explode(F.array(*map(F.lit, names))).alias("table_name")


def check_not_null(tables: Tables) -> DataFrame:
    """(table_name, column_name, violations) for every rule, also those that hold; one pass per set of rows."""
    shared = _shared([(table, column) for table, columns in NOT_NULL.items() for column in columns])
    frames = []
    for rows in dict.fromkeys(rows for rows, _ in shared):
        named = {column: names for (where, column), names in shared.items() if where == rows}
        owners = F.create_map(*[part for c, names in named.items() for part in (F.lit(c), F.array(*map(F.lit, names)))])
        counts = Q.null_counts(tables(rows), list(named))
        frames.append(counts.select(F.explode(owners[F.col("column_name")]).alias("table_name"), "*"))
    return union_all(frames)


def check_unique(tables: Tables) -> DataFrame:
    """Repeated values, as (table_name, column_name, value, n_rows)."""
    frames = [
        _tagged(Q.unique(tables(table), column).withColumnRenamed(column, "value"), table, column)
        for table, column in UNIQUE
    ]
    return union_all(frames)


def check_unique_combinations(tables: Tables) -> DataFrame:
    """Repeated combinations, as (table_name, column_name, value, n_rows)."""
    frames = []
    for (rows, columns), names in _shared([(table, tuple(columns)) for table, columns in UNIQUE_COMBINATIONS]).items():
        value = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        repeated = Q.unique_combination(tables(rows), list(columns))
        frames.append(repeated.select(_for_tables(names), F.lit(",".join(columns)).alias("column_name"), value.alias("value"), "n_rows"))
    return union_all(frames)


def check_accepted_values(tables: Tables, rules: RentalRules) -> DataFrame:
    """Values outside their domain, as (table_name, column_name, value, n_rows, severity)."""
    frames = [
        _tagged(Q.accepted_values(tables(table), column, values, severity), table, column)
        for table, column, values, severity in accepted_value_rules(rules)
    ]
    return union_all(frames)


def check_relationships(tables: Tables) -> DataFrame:
    """Orphaned keys, as (table_name, column_name, orphan, n_rows)."""
    frames = [
        _tagged(Q.relationships(tables(child), column, tables(parent), parent_column), child, column)
        for child, column, parent, parent_column in RELATIONSHIPS
    ]
    return union_all(frames)


def check_revenue_coverage(host_mart: DataFrame, rules: RentalRules) -> DataFrame:
    """Cities in which too few hosts have an estimated revenue."""
    return Q.coverage_floor(
        host_mart, "estimated_annual_revenue", "city", "mart_host_profile", rules.min_revenue_coverage_pct, R.COVERAGE_MESSAGE
    )


def snapshot_listings(fact: DataFrame, dim_listing: DataFrame, rules: RentalRules) -> DataFrame:
    """(city, listing_id, neighbourhood_cleansed) of each city's latest snapshot, for reconciliation only.

    Derived from the fact with nothing that the marts use, so a fault in their window shows.
    """
    newest = fact.groupBy("city").agg(F.max("snapshot_date").alias("newest")).withColumnRenamed("city", "in_city")
    recent = (F.col("city").eqNullSafe(F.col("in_city"))) & (F.datediff("newest", "snapshot_date") <= rules.window_days)
    listed = fact.join(newest, recent).select("city", "listing_id").distinct()
    return listed.join(dim_listing.select("listing_id", "neighbourhood_cleansed"), "listing_id", "left")


def check_marts_consistency(
    fact: DataFrame,
    dim_listing: DataFrame,
    city_mart: DataFrame,
    neighbourhood_mart: DataFrame,
    host_mart: DataFrame,
    rules: RentalRules,
) -> DataFrame:
    """Cities in which a mart disagrees with the fact, with a reason."""

    def per_city(df: DataFrame) -> DataFrame:
        return df.groupBy("city").agg(F.count(F.lit(1)).alias("n"))

    listings = snapshot_listings(fact, dim_listing, rules)
    named = listings.filter(F.col("neighbourhood_cleansed") != R.UNASSIGNED_NEIGHBOURHOOD)
    by_city = city_mart.select("city", F.col("total_listings").alias("n"))
    by_neighbourhood = neighbourhood_mart.groupBy("city").agg(F.sum("total_listings").alias("n"))
    limits = (rules.max_count_diff_pct, R.COUNT_MESSAGE)
    return union_all(
        [
            Q.count_reconciliation(by_city, per_city(listings), "city", "mart_city_comparison", *limits),
            Q.count_reconciliation(by_neighbourhood, per_city(named), "city", "mart_neighbourhood_pressure", *limits),
            check_revenue_coverage(host_mart, rules),
        ]
    )
