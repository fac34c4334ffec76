"""Typed views over the raw text tables: one raw row in, one typed row out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.functions import cleanse as C
from rentpulse.functions import dates as D
from rentpulse.functions.numeric import cap, null_if_zero, safe_divide
from rentpulse.operators.winsorize import group_caps
from rentpulse.rules import RentalRules

_c = F.col

def _named(columns: dict[str, Column]) -> list[Column]:
    return [expr.alias(name) for name, expr in columns.items()]


def _detail_columns() -> dict[str, Column]:
    return {
        "listing_id": C.strict_long("id"),
        "name": _c("name"),
        "property_type": _c("property_type"),
        "room_type": _c("room_type"),
        "is_entire_home": C.equals_flag("room_type", R.ENTIRE_HOME),
        "accommodates": C.try_long("accommodates"),
        "bedrooms": C.try_double("bedrooms"),
        "beds": C.try_double("beds"),
        "bathrooms": C.try_double("bathrooms"),
        "bathrooms_text": _c("bathrooms_text"),
        "amenities": _c("amenities"),
        "instant_bookable": C.flag("instant_bookable"),
        "license": _c("license"),
        "city": _c("city"),
    }


def host_profile(entire_homes: Column, rules: RentalRules) -> Column:
    steps = [
        (rules.professional_host_homes, R.PROFESSIONAL_HOST),
        (rules.multi_host_homes, R.MULTI_HOST),
    ]
    return C.bucket_at_least(entire_homes, steps, R.SINGLE_HOST)


def availability_profile(days: Column, rules: RentalRules) -> Column:
    steps = [
        (rules.low_availability_days, R.LOW_AVAILABILITY),
        (rules.high_availability_days, R.PARTIAL_AVAILABILITY),
    ]
    return C.bucket_below(days, steps, R.FULL_AVAILABILITY)


def _host_columns(rules: RentalRules) -> dict[str, Column]:
    since = D.try_date("host_since")
    entire_homes = C.try_long("calculated_host_listings_count_entire_homes")
    return {
        "host_id": C.try_long("host_id"),
        "listing_id": C.try_long("id"),
        "host_name": _c("host_name"),
        "host_since": since,
        "host_seniority_years": D.years_between(since, rules.today),
        "host_is_superhost": C.flag("host_is_superhost"),
        "host_response_time": _c("host_response_time"),
        "host_response_rate": C.percent("host_response_rate"),
        "host_acceptance_rate": C.percent("host_acceptance_rate"),
        "host_has_profile_pic": C.flag("host_has_profile_pic"),
        "host_identity_verified": C.flag("host_identity_verified"),
        "calculated_host_listings_count": C.try_long("calculated_host_listings_count"),
        "calc_listings_entire_homes": entire_homes,
        "calc_listings_private_rooms": C.try_long("calculated_host_listings_count_private_rooms"),
        "calc_listings_shared_rooms": C.try_long("calculated_host_listings_count_shared_rooms"),
        "host_profile": host_profile(entire_homes, rules),
        "city": _c("city"),
    }


def _location_columns() -> dict[str, Column]:
    return {
        "listing_id": C.try_long("id"),
        "neighbourhood_cleansed": F.trim(_c("neighbourhood_cleansed")),
        "latitude": C.try_double("latitude"),
        "longitude": C.try_double("longitude"),
        "city": _c("city"),
    }


def _review_score_columns(rules: RentalRules) -> dict[str, Column]:
    last_review = D.try_date("last_review")
    counts = ["number_of_reviews", "number_of_reviews_ltm", "number_of_reviews_l30d", "number_of_reviews_ly"]
    scores = ["rating", "accuracy", "cleanliness", "checkin", "communication", "location", "value"]
    return {
        "listing_id": C.try_long("id"),
        **{name: C.try_long(name) for name in counts},
        "reviews_per_month": C.try_double("reviews_per_month"),
        "first_review": D.try_date("first_review"),
        "last_review": last_review,
        "days_since_last_review": D.days_between(last_review, rules.today),
        **{f"review_scores_{name}": C.try_double(f"review_scores_{name}") for name in scores},
        "city": _c("city"),
    }


def _availability_columns(rules: RentalRules) -> dict[str, Column]:
    days = C.try_long("availability_365")
    return {
        "listing_id": C.try_long("id"),
        "price_raw": _c("price"),
        "price_numeric": C.currency("price"),
        "minimum_nights": C.try_long("minimum_nights"),
        "maximum_nights": C.try_long("maximum_nights"),
        "has_availability": C.flag("has_availability"),
        "availability_30": C.try_long("availability_30"),
        "availability_60": C.try_long("availability_60"),
        "availability_90": C.try_long("availability_90"),
        "availability_365": days,
        "is_high_availability": C.above_flag(days, rules.high_availability_days),
        "availability_profile": availability_profile(days, rules),
        "estimated_occupancy_l365d": C.try_double("estimated_occupancy_l365d"),
        "estimated_revenue_l365d": C.currency("estimated_revenue_l365d"),
        "last_scraped": D.try_date("last_scraped"),
        "city": _c("city"),
    }


def _with_capped_price(df: DataFrame, caps: DataFrame) -> DataFrame:
    capped = cap(_c("price_numeric"), _c("price_cap"))
    return df.join(caps, "city", "left").withColumns(
        {
            "price_winsorized": capped,
            "price_per_person": safe_divide(capped, _c("__accommodates")),
            "estimated_revenue_adjusted": capped * null_if_zero(_c("estimated_occupancy_l365d")),
        }
    )


def price_caps(raw: DataFrame, rules: RentalRules) -> DataFrame:
    """The winsorization cap per city over all its raw rows (small written table)."""
    prices = raw.select("city", C.currency("price").alias("price_numeric"))
    return group_caps(prices, ["city"], "price_numeric", rules.cap_percentile, "price_cap")


def stg_details(raw: DataFrame) -> DataFrame:
    return raw.select(*_named(_detail_columns()))


def stg_host(raw: DataFrame, rules: RentalRules) -> DataFrame:
    return raw.select(*_named(_host_columns(rules)))


def stg_location(raw: DataFrame) -> DataFrame:
    return raw.select(*_named(_location_columns()))


AVAILABILITY_OUTPUT = [
    "listing_id",
    "price_raw",
    "price_numeric",
    "price_winsorized",
    "price_per_person",
    "minimum_nights",
    "maximum_nights",
    "has_availability",
    "availability_30",
    "availability_60",
    "availability_90",
    "availability_365",
    "is_high_availability",
    "availability_profile",
    "estimated_occupancy_l365d",
    "estimated_revenue_l365d",
    "estimated_revenue_adjusted",
    "last_scraped",
    "city",
]


def stg_availability(raw: DataFrame, rules: RentalRules, caps: DataFrame | None = None) -> DataFrame:
    caps = price_caps(raw, rules) if caps is None else caps
    typed = raw.select(*_named(_availability_columns(rules)), C.try_long("accommodates").alias("__accommodates"))
    return _with_capped_price(typed, caps).select(*AVAILABILITY_OUTPUT)


def stg_review_scores(raw: DataFrame, rules: RentalRules) -> DataFrame:
    return raw.select(*_named(_review_score_columns(rules)))


def stg_reviews(raw: DataFrame) -> DataFrame:
    day = D.try_date("date")
    return raw.select(
        C.try_long("id").alias("review_id"),
        C.try_long("listing_id").alias("listing_id"),
        C.try_long("reviewer_id").alias("reviewer_id"),
        day.alias("review_date"),
        F.year(day).alias("review_year"),
        F.month(day).alias("review_month"),
        D.month_start(day).alias("review_month_start"),
        "city",
    )


def typed_listings(raw: DataFrame, rules: RentalRules) -> DataFrame:
    """All typed columns of a raw listing that need no statistic of its city: a plain projection."""
    columns = {
        **_detail_columns(),
        **_host_columns(rules),
        **_location_columns(),
        **_review_score_columns(rules),
        **_availability_columns(rules),
        "listing_id": C.strict_long("id"),
        "__accommodates": C.try_long("accommodates"),
    }
    return raw.select(*_named(columns))


def wide_listings(raw: DataFrame, rules: RentalRules, caps: DataFrame) -> DataFrame:
    """All typed columns of a raw listing in one projection.

    The typed views are projections of the same raw row, so reading them together replaces a
    self-join by listing id; it also keeps a row's attributes together when a listing occurs in
    several cities or snapshots.
    """
    wide = _with_capped_price(typed_listings(raw, rules), caps)
    return wide.withColumnRenamed("last_scraped", "snapshot_date").drop("price_cap", "__accommodates")
