import datetime as dt

from rentpulse.rules import RentalRules
from rentpulse.sources import extracts, tables
from rentpulse.streaming.arrivals import load_arrivals

RULES = RentalRules(as_of=dt.date(2026, 7, 15))


def test_arrivals_load_once(spark, tmp_path):
    schema = extracts.text_schema([*extracts.LISTING_COLUMNS, "city"])
    reviews = spark.createDataFrame([], extracts.text_schema([*extracts.REVIEW_COLUMNS, "city"]))
    bronze, root, checkpoint = (str(tmp_path / name) for name in ("bronze", "gold", "checkpoint"))

    def arrive(listing_id, city, scraped):
        row = {"id": listing_id, "city": city, "last_scraped": scraped, "host_id": "1", "price": "$10.00"}
        tables.append_rows(spark.createDataFrame([tuple(row.get(c) for c in schema.names)], schema), bronze, ["city"])

    def loaded():
        load_arrivals(spark, bronze, root, checkpoint, reviews, RULES).awaitTermination()
        stored = spark.read.parquet(f"{root}/fact_listings")
        return sorted((r.listing_id, r.city) for r in stored.collect())

    arrive("1", "madrid", "2026-07-02")
    assert loaded() == [(1, "madrid")]
    assert loaded() == [(1, "madrid")]
    arrive("2", "euskadi", "2026-06-28")
    assert loaded() == [(1, "madrid"), (2, "euskadi")]
