"""Load the snapshots that arrive in a bronze folder, each file once.

The stream only says that something arrived; the load itself is the batch one, over the whole
bronze table, because caps and dimensions depend on all raw rows. It is idempotent, so a batch that
is replayed after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rentpulse.plans.warehouse import PublishedWarehouse
from rentpulse.rules import RentalRules
from rentpulse.sources.extracts import LISTING_COLUMNS, text_schema


def load_arrivals(
    spark: SparkSession, bronze: str, root: str, checkpoint: str, reviews: DataFrame, rules: RentalRules
) -> StreamingQuery:
    """Process everything that arrived since the last call, then stop."""
    schema = text_schema([*LISTING_COLUMNS, "city"])

    def load(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            listings = batch.sparkSession.read.schema(schema).parquet(bronze)
            PublishedWarehouse(root, listings, reviews, rules).fact_listings.isEmpty()

    return (
        spark.readStream.schema(schema)
        .parquet(bronze)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
