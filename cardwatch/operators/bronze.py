"""Bronze layer: raw records as they arrive, plus lineage columns.

Each function maps a frame to a frame, so it serves a stream (the usual
case) and a batch backfill alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze_transactions(envelope: DataFrame) -> DataFrame:
    """Kafka rows with key and value as text and the ingestion time."""
    return (envelope
            .withColumn("key", F.col("key").cast("string"))
            .withColumn("value", F.col("value").cast("string"))
            .withColumn("ingestion_timestamp", F.current_timestamp()))


def bronze_watchlist(records: DataFrame) -> DataFrame:
    """Watchlist records (with the file each came from) and the ingestion time."""
    return records.withColumn("ingestion_timestamp", F.current_timestamp())


def bronze_customers(customers: DataFrame) -> DataFrame:
    """Customer master rows with the ingestion time."""
    return customers.withColumn("ingestion_timestamp", F.current_timestamp())
