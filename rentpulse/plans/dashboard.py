"""The datasets behind the dashboard: headline figures, series and rankings.

Each takes finished marts; ``city`` is the optional drill-down on the display label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.functions import labels as L
from rentpulse.operators.joins import left_join_known

FIRST_REVIEW_YEAR = 2015
MIN_SCATTER_LISTINGS = 50
MIN_RANKED_LISTINGS = 20

# The columns of the extract, in their order.
EXPORT_COLUMNS = [
    "listing_id",
    "city",
    "is_entire_home",
    "is_high_availability",
    "is_active_listing",
    "price_winsorized",
    "price_per_person",
    "estimated_occupancy_l365d",
    "estimated_revenue_adjusted",
    "availability_365",
    "availability_profile",
    "host_profile",
    "number_of_reviews_ltm",
    "review_scores_rating",
    "snapshot_date",
    "neighbourhood_cleansed",
    "latitude",
    "longitude",
]


def with_city_label(df: DataFrame) -> DataFrame:
    return df.withColumn("ciudad", L.mapped_label(F.col("city"), R.CITY_LABELS))


def for_city(df: DataFrame, city: str | None) -> DataFrame:
    """Labelled rows of one city, or of all."""
    labelled = with_city_label(df)
    return labelled if city is None else labelled.filter(F.col("ciudad") == city)


def listings_extract(fact: DataFrame, dim_neighbourhood: DataFrame, dim_listing: DataFrame) -> DataFrame:
    """Active listings of every stored snapshot with place and coordinates."""
    names = dim_neighbourhood.select("neighbourhood_id", "neighbourhood_cleansed")
    places = dim_listing.select("listing_id", "latitude", "longitude")
    named = left_join_known(fact.filter("is_active_listing"), names, ["neighbourhood_id"], "listing_id")
    return named.join(places, "listing_id", "left").select(*EXPORT_COLUMNS)


def _or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def _zero_without(marker: str, value: Column) -> Column:
    """Zero if no row carries the marker; an average over NULLs only stays NULL."""
    return F.when(F.count(marker) == 0, F.lit(0.0)).otherwise(value)


def capture_kpis(city_mart: DataFrame, neighbourhood_mart: DataFrame, city: str | None = None) -> DataFrame:
    """Listings, mean entire-home share, mean occupancy, distinct neighbourhood names.

    Both marts go through one aggregate as one union, so no one-row frames are joined.
    """
    cities = for_city(city_mart, city).select("total_listings", "pct_entire_home", "avg_occupancy_days")
    names = for_city(neighbourhood_mart, city).select("neighbourhood_cleansed")
    return cities.unionByName(names, allowMissingColumns=True).agg(
        _or_zero(F.sum("total_listings")).alias("total_listings"),
        _zero_without("total_listings", F.avg("pct_entire_home")).alias("pct_entire_home"),
        _zero_without("total_listings", F.avg("avg_occupancy_days")).alias("avg_occupancy_days"),
        F.countDistinct("neighbourhood_cleansed").alias("total_neighbourhoods"),
    )


def neighbourhood_scatter(
    neighbourhood_mart: DataFrame, min_listings: int = MIN_SCATTER_LISTINGS, city: str | None = None
) -> DataFrame:
    columns = [
        "neighbourhood_cleansed",
        "ciudad",
        "total_listings",
        "pct_entire_home",
        "total_entire_home",
        "pressure_score",
    ]
    return for_city(neighbourhood_mart, city).filter(F.col("total_listings") >= min_listings).select(*columns)


def reviews_by_year(reviews: DataFrame, city: str | None = None, first_year: int = FIRST_REVIEW_YEAR) -> DataFrame:
    recent = reviews.filter(F.col("review_year") >= first_year)
    return for_city(recent, city).groupBy("review_year", "ciudad").agg(F.sum("total_reviews").alias("total_reviews"))


def reviews_national(by_year: DataFrame) -> DataFrame:
    return by_year.groupBy("review_year").agg(F.sum("total_reviews").alias("total_reviews"))


def reviews_top_cities(by_year: DataFrame, n: int = 5) -> DataFrame:
    """Yearly series of the n cities with most reviews."""
    totals = by_year.groupBy("ciudad").agg(F.sum("total_reviews").alias("__total"))
    top = totals.orderBy(F.desc("__total"), "ciudad").limit(n).select("ciudad")
    return by_year.join(top, "ciudad", "left_semi")


def reviews_stacked(by_year: DataFrame) -> DataFrame:
    """Yearly series with the city total that orders the stack."""
    totals = by_year.groupBy("ciudad").agg(F.sum("total_reviews").alias("city_total"))
    return by_year.join(totals, "ciudad").orderBy(F.desc("city_total"), "ciudad", "review_year")


def host_kpis(host_mart: DataFrame, city: str | None = None) -> DataFrame:
    """Distinct hosts, shares of professional and multi hosts, share of professional listings."""
    professional = F.col("host_profile") == R.PROFESSIONAL_HOST
    multi = F.col("host_profile") != R.SINGLE_HOST
    per_host = (
        for_city(host_mart, city)
        .groupBy("host_id")
        .agg(
            F.bool_or(professional).alias("professional"),
            F.bool_or(multi).alias("multi"),
            F.sum("total_listings").alias("listings"),
            F.sum(F.when(professional, F.col("total_listings"))).alias("professional_listings"),
        )
    )
    hosts = F.greatest(F.count("host_id"), F.lit(1))
    listings = F.greatest(_or_zero(F.sum("listings")), F.lit(1))
    return per_host.agg(
        F.count("host_id").alias("total_hosts"),
        (F.count_if("professional") / hosts * 100).alias("pct_professional_hosts"),
        (F.count_if("multi") / hosts * 100).alias("pct_multi_hosts"),
        (_or_zero(F.sum("professional_listings")) / listings * 100).alias("pct_professional_listings"),
    )


def hosts_by_profile(host_mart: DataFrame, city: str | None = None) -> DataFrame:
    return for_city(host_mart, city).groupBy("host_profile").agg(F.countDistinct("host_id").alias("num_hosts"))


def listings_by_profile(host_mart: DataFrame, city: str | None = None) -> DataFrame:
    return (
        for_city(host_mart, city).groupBy("ciudad", "host_profile").agg(F.sum("total_listings").alias("total_listings"))
    )


def listings_by_profile_wide(host_mart: DataFrame, city: str | None = None) -> DataFrame:
    """One row per city, one column per profile of the fixed domain; 0 where a city has none of it."""
    profiles = [R.SINGLE_HOST, R.MULTI_HOST, R.PROFESSIONAL_HOST]
    counted = for_city(host_mart, city).groupBy("ciudad").pivot("host_profile", profiles).agg(F.sum("total_listings"))
    names = ["single_host", "multi_host", "professional_host"]
    return counted.select("ciudad", *[_or_zero(F.col(p)).cast("bigint").alias(n) for p, n in zip(profiles, names, strict=True)])


def money_kpis(city_mart: DataFrame, host_mart: DataFrame, city: str | None = None) -> DataFrame:
    """Mean median price, mean revenue, mean professional revenue, mean multi-host share."""
    cities = for_city(city_mart, city).select(
        "total_listings", "median_price_winsorized", "avg_estimated_revenue", "pct_multihost_listings"
    )
    professional = F.col("host_profile") == R.PROFESSIONAL_HOST
    hosts = for_city(host_mart, city).select(
        "host_id", F.when(professional, F.col("estimated_annual_revenue")).alias("professional_revenue")
    )
    return cities.unionByName(hosts, allowMissingColumns=True).agg(
        _zero_without("total_listings", F.avg("median_price_winsorized")).alias("median_price"),
        _zero_without("total_listings", F.avg("avg_estimated_revenue")).alias("avg_revenue"),
        _zero_without("host_id", F.avg("professional_revenue")).alias("avg_professional_revenue"),
        _zero_without("total_listings", F.avg("pct_multihost_listings")).alias("pct_multihost_listings"),
    )


def top_neighbourhoods(
    neighbourhood_mart: DataFrame,
    n: int = 15,
    min_listings: int = MIN_RANKED_LISTINGS,
    city: str | None = None,
) -> DataFrame:
    return (
        for_city(neighbourhood_mart, city)
        .filter(F.col("total_listings") >= min_listings)
        .orderBy(F.desc_nulls_last("avg_estimated_revenue"), "neighbourhood_cleansed", "ciudad")
        .limit(n)
        .select(
            "neighbourhood_cleansed",
            "ciudad",
            "avg_estimated_revenue",
            "median_price_winsorized",
            "total_listings",
        )
    )


def city_table(city_mart: DataFrame, city: str | None = None) -> DataFrame:
    return (
        for_city(city_mart, city)
        .select(
            "ciudad",
            "total_listings",
            "pct_entire_home",
            "median_price_winsorized",
            "avg_estimated_revenue",
            "pct_professional_operators",
        )
        .orderBy(F.desc("total_listings"), "ciudad")
    )


def city_table_display(table: DataFrame) -> DataFrame:
    """The city table as shown: thousands separators, percent and dollar signs."""
    return table.select(
        "ciudad",
        L.format_count(F.col("total_listings")).alias("total_listings"),
        L.format_pct(F.col("pct_entire_home")).alias("pct_entire_home"),
        L.format_money(F.col("median_price_winsorized")).alias("median_price_winsorized"),
        L.format_money(F.col("avg_estimated_revenue")).alias("avg_estimated_revenue"),
        L.format_pct(F.col("pct_professional_operators")).alias("pct_professional_operators"),
    )


def top_hosts(host_mart: DataFrame, n: int = 10, city: str | None = None) -> DataFrame:
    """Professional hosts with the highest yearly revenue."""
    return (
        for_city(host_mart, city)
        .filter(F.col("host_profile") == R.PROFESSIONAL_HOST)
        .orderBy(F.desc_nulls_last("estimated_annual_revenue"), "host_id", "ciudad")
        .limit(n)
        .select("host_name", "ciudad", "total_listings", "entire_home_listings", "estimated_annual_revenue")
    )
