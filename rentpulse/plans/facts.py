"""Facts of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentpulse.operators.dedup import keep_first
from rentpulse.operators.joins import left_join_known
from rentpulse.plans.dims import neighbourhood_key, with_room_type_id
from rentpulse.rules import RentalRules

FACT_KEYS = ["listing_id", "snapshot_date"]
FACT_PARTITIONS = ["city", "snapshot_date"]

FACT_COLUMNS = [
    "listing_id",
    "host_sk",
    "neighbourhood_id",
    "room_type_id",
    "price_winsorized",
    "price_per_person",
    "availability_profile",
    "availability_365",
    "is_high_availability",
    "estimated_occupancy_l365d",
    "estimated_revenue_l365d",
    "estimated_revenue_adjusted",
    "number_of_reviews_ltm",
    "reviews_per_month",
    "review_scores_rating",
    "days_since_last_review",
    "is_active_listing",
    "is_entire_home",
    "host_profile",
    "city",
    "snapshot_date",
]
_FROM_WIDE = [
    c
    for c in FACT_COLUMNS
    if c not in ("host_sk", "neighbourhood_id", "room_type_id", "is_active_listing", "host_profile")
]


def is_active(
    price: Column, availability: Column, reviews_ltm: Column, last_review: Column, rules: RentalRules
) -> Column:
    """Priced, available and recently reviewed; anything unknown counts as not active."""
    recent = (reviews_ltm > 0) | (last_review >= F.add_months(rules.today, -rules.activity_months))
    return F.coalesce(price.isNotNull() & (availability > 0) & recent, F.lit(False))


def fact_listings(wide: DataFrame, dim_host: DataFrame, rules: RentalRules) -> DataFrame:
    """One row per listing and snapshot date with measures and dimension keys.

    Rows are reduced to one per key before the host join. Neighbourhood and room-type keys need
    no shuffle: one is a hash of the row's own columns, the other a four-row lookup.
    """
    rows = wide.select(
        *_FROM_WIDE,
        "host_id",
        "room_type",
        neighbourhood_key(F.col("neighbourhood_cleansed"), F.col("city")).alias("neighbourhood_id"),
        is_active(
            F.col("price_winsorized"),
            F.col("availability_365"),
            F.col("number_of_reviews_ltm"),
            F.col("last_review"),
            rules,
        ).alias("is_active_listing"),
    )
    unique = keep_first(rows, FACT_KEYS, [F.col("city").asc_nulls_last()])
    hosts = dim_host.select("host_id", "city", "host_sk", "host_profile")
    return left_join_known(with_room_type_id(unique), hosts, ["host_id", "city"], "listing_id").select(*FACT_COLUMNS)


def fact_reviews_monthly(reviews: DataFrame) -> DataFrame:
    """Reviews and distinct reviewed listings per city and month."""
    return (
        reviews.filter(F.col("review_date").isNotNull())
        .groupBy("city", "review_year", "review_month", "review_month_start")
        .agg(
            F.count(F.lit(1)).alias("total_reviews"),
            F.countDistinct("listing_id").alias("distinct_listings"),
        )
    )
