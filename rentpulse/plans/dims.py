"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.functions.cleanse import above_flag
from rentpulse.functions.keys import surrogate_key
from rentpulse.operators.dedup import keep_first
from rentpulse.rules import RentalRules


def dim_room_type(spark: SparkSession) -> DataFrame:
    """The fixed four-row lookup."""
    schema = "room_type_id bigint, room_type string, room_type_es string, is_entire_home boolean"
    return spark.createDataFrame(list(R.ROOM_TYPES), schema)


def with_room_type_id(df: DataFrame) -> DataFrame:
    """Left lookup join; the lookup has four rows by definition, so it is broadcast."""
    lookup = dim_room_type(df.sparkSession).select("room_type", "room_type_id")
    return df.join(F.broadcast(lookup), "room_type", "left")


def is_assigned(neighbourhood: Column) -> Column:
    return neighbourhood.isNotNull() & (neighbourhood != R.UNASSIGNED_NEIGHBOURHOOD)


def neighbourhood_key(neighbourhood: Column, city: Column) -> Column:
    """Key of the neighbourhood dimension, NULL where the dimension has no such row.

    The dimension holds every assigned (neighbourhood, city) pair of the same listings, so the
    key can be computed instead of joined.
    """
    return F.when(is_assigned(neighbourhood) & city.isNotNull(), surrogate_key(neighbourhood, city))


def dim_neighbourhood(location: DataFrame) -> DataFrame:
    name = F.trim("neighbourhood_cleansed")
    pairs = location.select(name.alias("neighbourhood_cleansed"), "city").filter(
        is_assigned(F.col("neighbourhood_cleansed"))
    )
    return pairs.distinct().select(
        surrogate_key(F.col("neighbourhood_cleansed"), F.col("city")).alias("neighbourhood_id"),
        "neighbourhood_cleansed",
        "city",
    )


DIM_LISTING_COLUMNS = [
    "listing_id",
    "room_type_id",
    "neighbourhood_id",
    "name",
    "property_type",
    "room_type",
    "is_entire_home",
    "accommodates",
    "neighbourhood_cleansed",
    "latitude",
    "longitude",
    "city",
]


def dim_listing(wide: DataFrame) -> DataFrame:
    """One row per listing: its newest snapshot, by city where it occurs in several."""
    needed = [c for c in DIM_LISTING_COLUMNS if c not in ("room_type_id", "neighbourhood_id")]
    newest_first = [F.col("snapshot_date").desc_nulls_last(), F.col("city").asc_nulls_last()]
    unique = keep_first(wide.select(*needed, "snapshot_date"), ["listing_id"], newest_first)
    key = neighbourhood_key(F.col("neighbourhood_cleansed"), F.col("city"))
    return with_room_type_id(unique).withColumn("neighbourhood_id", key).select(*DIM_LISTING_COLUMNS)


DIM_HOST_COLUMNS = [
    "host_sk",
    "host_id",
    "city",
    "host_name",
    "host_since",
    "host_seniority_years",
    "host_is_superhost",
    "calculated_host_listings_count",
    "calc_listings_entire_homes",
    "host_profile",
    "is_multihost",
]


def dedup_host(host: DataFrame) -> DataFrame:
    """One row per host and city: the most complete record, then the newest, then by content."""
    order = [F.col("calculated_host_listings_count").desc_nulls_last()]
    return keep_first(host.filter(F.col("host_id").isNotNull()), ["host_id", "city"], order)


def dim_host(host: DataFrame, rules: RentalRules) -> DataFrame:
    attributes = [c for c in DIM_HOST_COLUMNS if c not in ("host_sk", "is_multihost")]
    unique = dedup_host(host.select(*attributes))
    return unique.withColumns(
        {
            "host_sk": surrogate_key(F.col("host_id"), F.col("city")),
            "is_multihost": above_flag(F.col("calculated_host_listings_count"), 1),
        }
    ).select(*DIM_HOST_COLUMNS)
