"""From bronze to marts: the tables in dependency order, each computed once."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentpulse.functions.dates import try_date
from rentpulse.operators.incremental import incremental_load, unseen_partitions
from rentpulse.operators.scd2 import scd2_first_load, scd2_step
from rentpulse.plans import checks, dashboard, dims, facts, marts, silver
from rentpulse.rules import RentalRules
from rentpulse.sources import tables as T
from rentpulse.sources.change_log import ChangeLog
from rentpulse.sources.manifest import live_partitions, versions
from rentpulse.sources.scratch import materialize

SCD2_KEY = "host_sk"
SCD2_CHECK_COLUMNS = ["calculated_host_listings_count", "host_profile"]


class Warehouse:
    """Named tables over one state of the raw data.

    Silver tables are lazy views. Tables with several consumers are written to the shared folder
    on first use, so that no consumer recomputes the star.
    """

    def __init__(self, raw_listings: DataFrame, raw_reviews: DataFrame, rules: RentalRules | None = None):
        self.raw_listings = raw_listings
        self.raw_reviews = raw_reviews
        self.spark: SparkSession = raw_listings.sparkSession
        self.rules = (rules or RentalRules()).resolved(self.spark)

    @cached_property
    def price_caps(self) -> DataFrame:
        return silver.price_caps(self.raw_listings, self.rules)

    @cached_property
    def typed_listings(self) -> DataFrame:
        return silver.typed_listings(self.raw_listings, self.rules)

    @cached_property
    def wide(self) -> DataFrame:
        return silver.wide_listings(self.raw_listings, self.rules, self.price_caps)

    @cached_property
    def stg_details(self) -> DataFrame:
        return silver.stg_details(self.raw_listings)

    @cached_property
    def stg_host(self) -> DataFrame:
        return silver.stg_host(self.raw_listings, self.rules)

    @cached_property
    def stg_location(self) -> DataFrame:
        return silver.stg_location(self.raw_listings)

    @cached_property
    def stg_availability(self) -> DataFrame:
        return silver.stg_availability(self.raw_listings, self.rules, self.price_caps)

    @cached_property
    def stg_review_scores(self) -> DataFrame:
        return silver.stg_review_scores(self.raw_listings, self.rules)

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return silver.stg_reviews(self.raw_reviews)

    @cached_property
    def dim_room_type(self) -> DataFrame:
        return dims.dim_room_type(self.spark)

    @cached_property
    def dim_neighbourhood(self) -> DataFrame:
        return dims.dim_neighbourhood(self.stg_location)

    @cached_property
    def dim_listing(self) -> DataFrame:
        return dims.dim_listing(self.wide)

    @cached_property
    def dim_host(self) -> DataFrame:
        return materialize(dims.dim_host(self.stg_host, self.rules), "dim_host")

    @cached_property
    def fact_listings(self) -> DataFrame:
        return materialize(facts.fact_listings(self.wide, self.dim_host, self.rules), "fact_listings")

    @cached_property
    def fact_reviews_monthly(self) -> DataFrame:
        return materialize(facts.fact_reviews_monthly(self.stg_reviews), "fact_reviews_monthly")

    @cached_property
    def window_listings(self) -> DataFrame:
        listings = marts.window_listings(self.fact_listings, self.dim_listing, self.rules)
        return materialize(listings, "window_listings")

    @cached_property
    def mart_neighbourhood_pressure(self) -> DataFrame:
        return marts.mart_neighbourhood_pressure(self.window_listings, self.rules)

    @cached_property
    def mart_host_profile(self) -> DataFrame:
        return marts.mart_host_profile(self.dim_host, self.window_listings)

    @cached_property
    def mart_city_comparison(self) -> DataFrame:
        return marts.mart_city_comparison(self.window_listings, self.dim_host)

    @cached_property
    def listings_extract(self) -> DataFrame:
        return dashboard.listings_extract(self.fact_listings, self.dim_neighbourhood, self.dim_listing)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def load_checks(self) -> dict[str, DataFrame]:
        """Checks of the load itself, as (table_name, detail, severity) by check name."""
        return {}

    def marts_consistency(self) -> DataFrame:
        return checks.check_marts_consistency(
            self.fact_listings,
            self.dim_listing,
            self.mart_city_comparison,
            self.mart_neighbourhood_pressure,
            self.mart_host_profile,
            self.rules,
        )


GOLD_TABLES = [
    "dim_room_type",
    "dim_neighbourhood",
    "fact_reviews_monthly",
    "mart_neighbourhood_pressure",
    "mart_host_profile",
    "mart_city_comparison",
]
EXPORTED_TABLES = [
    "mart_neighbourhood_pressure",
    "mart_city_comparison",
    "mart_host_profile",
    "fact_reviews_monthly",
    "dim_neighbourhood",
    "dim_room_type",
]


class PublishedWarehouse(Warehouse):
    """The same tables kept under a root folder, with the fact loaded incrementally."""

    def __init__(
        self, root: str, raw_listings: DataFrame, raw_reviews: DataFrame, rules: RentalRules | None = None
    ):
        super().__init__(raw_listings, raw_reviews, rules)
        self.root = root

    def _publish(self, name: str, df: DataFrame) -> DataFrame:
        return T.publish_version(df, f"{self.root}/{name}")

    @cached_property
    def dim_listing(self) -> DataFrame:
        return self._publish("dim_listing", dims.dim_listing(self.wide))

    @cached_property
    def dim_host(self) -> DataFrame:
        return self._publish("dim_host", dims.dim_host(self.stg_host, self.rules))

    @cached_property
    def fact_listings(self) -> DataFrame:
        """Stored fact plus the unseen snapshots.

        Already loaded snapshots are filtered out of the raw rows, before casts, joins and
        de-duplication, so a load costs what is new rather than the whole history.
        """
        path = f"{self.root}/fact_listings"
        raw = self.raw_listings.filter(try_date("last_scraped").isNotNull() & F.col("city").isNotNull())

        def fact(listings: DataFrame) -> DataFrame:
            return facts.fact_listings(silver.wide_listings(listings, self.rules, self.price_caps), self.dim_host, self.rules)

        if versions(self.spark, path):
            seen = live_partitions(self.spark, path, fact(raw).schema, facts.FACT_PARTITIONS)
            dated = raw.withColumn("snapshot_date", try_date("last_scraped"))
            raw = unseen_partitions(dated, seen, facts.FACT_PARTITIONS).drop("snapshot_date")
        return incremental_load(fact(raw), path, facts.FACT_PARTITIONS, facts.FACT_KEYS)

    @cached_property
    def rejected_listings(self) -> DataFrame:
        """Raw listings the fact cannot place: without city or a readable scrape date. The rest loads."""
        bad = try_date("last_scraped").isNull() | F.col("city").isNull()
        return self._publish("rejected_listings", self.raw_listings.filter(bad))

    def host_history(self, as_of: dt.date) -> DataFrame:
        """Apply the current host dimension to the stored history and return the new history.

        Each run appends the versions it opened and closed, nothing for hosts that did not change; see
        ``ChangeLog`` for how they are kept. No run overwrites what it reads.
        """
        step = scd2_first_load(self.dim_host, as_of)
        log = ChangeLog(self.spark, f"{self.root}/dim_host_snapshot", SCD2_KEY, step.schema)
        if log.runs():
            step = scd2_step(log.open_versions(), self.dim_host, SCD2_KEY, SCD2_CHECK_COLUMNS, as_of, changes_only=True)
        log.append(step)
        return log.history()

    def build(self, as_of: dt.date) -> DataFrame:
        """Publish every gold table and return the failed checks as (check_name, table_name, detail)."""
        self.host_history(as_of)
        for name in GOLD_TABLES:
            self.__dict__[name] = self._publish(name, self.table(name))
        return self.failed_checks()

    def load_checks(self) -> dict[str, DataFrame]:
        counts = T.group_counts(self.rejected_listings, "city")
        detail = F.concat(F.col("n").cast("string"), F.lit(" rows without a usable key in "), F.coalesce("city", F.lit("no city")))
        return {"rejected": counts.select(F.lit("raw_listings"), detail, F.lit("error"))}

    def failed_checks(self) -> DataFrame:
        """All quality rules in one frame; no row of severity ``error`` means the build is good."""
        rows = F.concat(F.col("n_rows").cast("string"), F.lit(" rows with "))
        parts = {
            "not_null": checks.check_not_null(self.table)
            .filter("violations > 0")
            .select("table_name", F.concat_ws(": ", "column_name", F.col("violations").cast("string")), F.lit("error")),
            "unique": checks.check_unique(self.table).select(
                "table_name", F.concat(rows, F.col("value")), F.lit("error")
            ),
            "unique_combination": checks.check_unique_combinations(self.table).select(
                "table_name", F.concat(rows, F.col("value")), F.lit("error")
            ),
            "accepted_values": checks.check_accepted_values(self.table, self.rules).select(
                "table_name", F.concat(rows, F.col("value")), "severity"
            ),
            "relationships": checks.check_relationships(self.table).select(
                "table_name", F.concat(rows, F.col("orphan")), F.lit("error")
            ),
            "consistency": self.marts_consistency().select(
                "mart", F.concat_ws(": ", "city", "detail"), F.lit("error")
            ),
        } | self.load_checks()
        frames = [df.toDF("table_name", "detail", "severity").withColumn("check_name", F.lit(name)) for name, df in parts.items()]
        return checks.union_all(frames).select("check_name", "table_name", "severity", "detail")

    def export(self, out_dir: str) -> list[T.ExportResult]:
        """Write the tables the dashboard reads."""
        exported = {name: self.table(name) for name in EXPORTED_TABLES}
        return T.export_tables({**exported, "fact_listings_dashboard": self.listings_extract}, out_dir)
