"""Silver layer: parsed, typed and checked records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expressions import parse_open_date, parse_watchlist_time
from ..schemas import TRANSACTION_PAYLOAD
from .quality import Expectation, apply_expectations, expect, expect_or_drop

# The checks the silver transactions table applies.
TRANSACTION_EXPECTATIONS = [
    expect_or_drop("valid_transaction_id", "transaction_id IS NOT NULL"),
    expect_or_drop("valid_customer_id", "customer_id IS NOT NULL"),
    expect_or_drop("valid_card_number", "card_number IS NOT NULL"),
    expect_or_drop("valid_merchant_id", "merchant_id IS NOT NULL"),
    expect("valid_amount", "amount > 0"),
]
CUSTOMER_EXPECTATIONS = [
    expect_or_drop("valid_customer_id", "customer_id IS NOT NULL"),
]

LINEAGE = {
    "topic": "kafka_topic",
    "partition": "kafka_partition",
    "offset": "kafka_offset",
    "timestamp": "kafka_timestamp",
    "ingestion_timestamp": "bronze_ingestion_timestamp",
}


def parse_transactions(bronze: DataFrame) -> DataFrame:
    """Message value parsed as a transaction document and flattened.

    ``from_json`` is permissive: text that is not a JSON object gives a row
    of NULL fields, a field of the wrong type gives NULL for that field.
    Kafka lineage columns are carried along under ``kafka_*`` names.
    """
    parsed = bronze.withColumn("parsed_value", F.from_json("value", TRANSACTION_PAYLOAD))
    lineage = [F.col(src).alias(dst) for src, dst in LINEAGE.items() if src in bronze.columns]
    return parsed.select(
        *[F.col(f"parsed_value.{f.name}").alias(f.name) for f in TRANSACTION_PAYLOAD.fields],
        *lineage,
    )


def silver_transactions(bronze: DataFrame, expectations: list[Expectation] | None = None,
                        observation: str | Observation = "silver_transactions") -> DataFrame:
    """Parsed transactions that pass the expectations, with the silver time.

    Failure counts are observed on the parsed rows before the drop; the drop
    filter sits above the observation, so the JSON is parsed once per row.
    """
    checked = apply_expectations(parse_transactions(bronze),
                                 TRANSACTION_EXPECTATIONS if expectations is None else expectations,
                                 observation)
    return checked.withColumn("silver_ingestion_timestamp", F.current_timestamp())


def silver_watchlist(bronze: DataFrame) -> DataFrame:
    """Upper-cased codes and a parsed ``effective_from``; no row is dropped."""
    out = (bronze
           .withColumn("watchlist_id", F.upper("watchlist_id"))
           .withColumn("risk_level", F.upper("risk_level"))
           .withColumn("action", F.upper("action"))
           .withColumn("effective_from", parse_watchlist_time("effective_from")))
    if "ingestion_timestamp" in bronze.columns:
        out = out.withColumnRenamed("ingestion_timestamp", "bronze_ingestion_timestamp")
    return out.withColumn("silver_ingestion_timestamp", F.current_timestamp())


def silver_customers(bronze: DataFrame,
                     observation: str | Observation = "silver_customers") -> DataFrame:
    """Customers with a known id and the open date as a date."""
    checked = apply_expectations(bronze, CUSTOMER_EXPECTATIONS, observation)
    return (checked
            .withColumn("account_open_date", parse_open_date("account_open_date"))
            .withColumn("silver_ingestion_timestamp", F.current_timestamp()))
