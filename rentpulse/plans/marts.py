"""Aggregates per neighbourhood, host and city over the latest snapshot window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.functions.numeric import exact_avg, exact_sum, safe_divide, share_pct, weighted_score
from rentpulse.operators.dedup import newest_per_key, within_latest
from rentpulse.operators.percentile import group_median
from rentpulse.plans.dims import is_assigned
from rentpulse.rules import RentalRules


def window_listings(fact: DataFrame, dim_listing: DataFrame, rules: RentalRules) -> DataFrame:
    """Each city's latest snapshot, one row per listing, with its neighbourhood name.

    All marts and the reconciliation read this one table. Joining before the de-duplication lets
    a shuffled join's partitioning by listing serve the de-duplication too.
    """
    recent = within_latest(fact, "city", "snapshot_date", rules.window_days)
    names = dim_listing.select("listing_id", "neighbourhood_cleansed")
    return newest_per_key(recent.join(names, "listing_id", "left"), "city", "listing_id", "snapshot_date")


def assigned(listings: DataFrame) -> DataFrame:
    return listings.filter(is_assigned(F.col("neighbourhood_cleansed")))


def _is_multihost() -> Column:
    return F.col("host_profile") != R.SINGLE_HOST


def _is_professional() -> Column:
    return F.col("host_profile") == R.PROFESSIONAL_HOST


def _avg(col: str, digits: int) -> Column:
    return F.round(exact_avg(F.col(col)), digits)


def _join_parts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two aggregates of the same rows; a NULL key matches itself."""
    renamed = right
    condition = F.lit(True)
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"__{key}")
        condition = condition & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return left.join(renamed, condition, "left").drop(*[f"__{key}" for key in keys])


def pressure_score(rules: RentalRules) -> Column:
    """Aggregate: weighted index over the unrounded shares."""
    return weighted_score(
        (share_pct(F.col("is_entire_home")), rules.entire_home_weight),
        (share_pct(F.col("is_high_availability")), rules.high_availability_weight),
        (share_pct(_is_multihost()), rules.multihost_weight),
    )


def mart_neighbourhood_pressure(listings: DataFrame, rules: RentalRules) -> DataFrame:
    """One row per neighbourhood and city with the pressure indicators."""
    keys = ["neighbourhood_cleansed", "city"]
    rows = assigned(listings)
    shares = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.count_if("is_active_listing").alias("total_active_listings"),
        F.count_if("is_entire_home").alias("total_entire_home"),
        F.round(share_pct(F.col("is_entire_home")), 2).alias("pct_entire_home"),
        F.count_if("is_high_availability").alias("total_high_availability"),
        F.round(share_pct(F.col("is_high_availability")), 2).alias("pct_high_availability"),
        _avg("price_per_person", 2).alias("avg_price_per_person"),
        _avg("estimated_occupancy_l365d", 1).alias("avg_occupancy_days"),
        _avg("estimated_revenue_adjusted", 2).alias("avg_estimated_revenue"),
        F.count_if(_is_multihost()).alias("total_multihost_listings"),
        F.round(share_pct(_is_multihost()), 2).alias("pct_multihost_listings"),
        F.round(share_pct(_is_professional()), 2).alias("pct_professional_operators"),
        _avg("review_scores_rating", 2).alias("avg_review_score"),
        F.round(pressure_score(rules), 2).alias("pressure_score"),
    )
    medians = group_median(rows, keys, "price_winsorized", "__median")
    return _join_parts(shares, medians, keys).select(
        "neighbourhood_cleansed",
        "city",
        "total_listings",
        "total_active_listings",
        "total_entire_home",
        "pct_entire_home",
        "total_high_availability",
        "pct_high_availability",
        F.round(F.col("__median"), 2).alias("median_price_winsorized"),
        "avg_price_per_person",
        "avg_occupancy_days",
        "avg_estimated_revenue",
        "total_multihost_listings",
        "pct_multihost_listings",
        "pct_professional_operators",
        "avg_review_score",
        "pressure_score",
    )


def mart_host_profile(dim_host: DataFrame, listings: DataFrame) -> DataFrame:
    """One row per host and city, also for hosts without a listing in the window.

    Listings are aggregated per host before the join, so a host with very many listings is
    combined map-side and the join is one row to one row.
    """
    earnings = listings.groupBy("host_sk").agg(
        _avg("price_per_person", 2).alias("avg_price_per_person"),
        _avg("estimated_occupancy_l365d", 1).alias("avg_occupancy"),
        F.round(exact_sum(F.col("estimated_revenue_adjusted")), 2).alias("estimated_annual_revenue"),
    )
    homes_pct = safe_divide(F.col("calc_listings_entire_homes"), F.col("calculated_host_listings_count")) * 100
    return dim_host.join(earnings, "host_sk", "left").select(
        "host_id",
        "host_name",
        "host_profile",
        "host_seniority_years",
        "city",
        F.col("calculated_host_listings_count").alias("total_listings"),
        F.col("calc_listings_entire_homes").alias("entire_home_listings"),
        F.round(homes_pct, 2).alias("pct_entire_home"),
        "avg_price_per_person",
        "avg_occupancy",
        "estimated_annual_revenue",
        F.col("host_is_superhost").alias("is_superhost"),
    )


def _host_shares(listings: DataFrame, dim_host: DataFrame) -> DataFrame:
    """Distinct hosts per city and the share of professionals among them.

    Distinct in two steps (host, then city) instead of two distinct counts in one aggregate,
    which would duplicate every row.
    """
    hosts = dim_host.select("host_sk", "host_id", "host_profile")
    per_host = (
        listings.select("city", "host_sk")
        .distinct()
        .join(hosts, "host_sk")
        .groupBy("city", "host_id")
        .agg(F.bool_or(_is_professional()).alias("__professional"))
    )
    return per_host.groupBy("city").agg(
        F.count("host_id").alias("total_hosts"),
        F.round(
            safe_divide(
                F.count_if(F.col("__professional") & F.col("host_id").isNotNull()), F.count("host_id")
            )
            * 100,
            2,
        ).alias("pct_professional_operators"),
    )


def mart_city_comparison(listings: DataFrame, dim_host: DataFrame) -> DataFrame:
    """One row per city, measures side by side."""
    shares = listings.groupBy("city").agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.count_if("is_active_listing").alias("total_active_listings"),
        F.round(share_pct(F.col("is_entire_home")), 2).alias("pct_entire_home"),
        _avg("price_per_person", 2).alias("avg_price_per_person"),
        _avg("estimated_occupancy_l365d", 1).alias("avg_occupancy_days"),
        _avg("estimated_revenue_adjusted", 2).alias("avg_estimated_revenue"),
        F.round(share_pct(_is_multihost()), 2).alias("pct_multihost_listings"),
        _avg("review_scores_rating", 2).alias("avg_review_score"),
    )
    medians = group_median(listings, ["city"], "price_winsorized", "__median")
    combined = _join_parts(_join_parts(shares, medians, ["city"]), _host_shares(listings, dim_host), ["city"])
    return combined.select(
        "city",
        "total_listings",
        "total_active_listings",
        "pct_entire_home",
        F.round(F.col("__median"), 2).alias("median_price_winsorized"),
        "avg_price_per_person",
        "avg_occupancy_days",
        "avg_estimated_revenue",
        F.coalesce("total_hosts", F.lit(0)).alias("total_hosts"),
        "pct_professional_operators",
        "pct_multihost_listings",
        "avg_review_score",
    )
