"""What listings offer: the amenities text as an array, and a row per listing and amenity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def amenity_list(text: Column) -> Column:
    """The texts of a JSON array; NULL for anything that is not one. NULL entries stay out."""
    return F.array_compact(F.try_variant_get(F.try_parse_json(text), "$", "array<string>"))


def listing_amenities(details: DataFrame) -> DataFrame:
    """Bridge of listings and amenities: one row per (listing_id, city, amenity), however often it is named."""
    lists = details.select("listing_id", "city", F.array_distinct(amenity_list(F.col("amenities"))).alias("amenities"))
    named = lists.select("listing_id", "city", F.explode("amenities").alias("amenity"))
    return named.select("listing_id", "city", F.trim("amenity").alias("amenity")).filter("amenity != ''").distinct()


def amenity_shares(bridge: DataFrame, details: DataFrame) -> DataFrame:
    """Listings with each amenity per city, and their share of the city's listings in percent.

    Both sides are aggregated before they meet; the totals have a row per city.
    """
    totals = details.groupBy("city").agg(F.countDistinct("listing_id").alias("listings"))
    with_it = bridge.groupBy("city", "amenity").agg(F.count(F.lit(1)).alias("n_listings"))
    share = F.round(F.col("n_listings") * 100 / F.col("listings"), 2)
    return with_it.join(totals, "city").select("city", "amenity", "n_listings", share.alias("pct_listings"))
