"""Declared schemas of every table the pipeline reads or writes."""

from pyspark.sql.types import (BinaryType, BooleanType, DecimalType,
                               DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType,
                               TimestampType)

MONEY = DecimalType(18, 2)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


# Names, types and order of the fields below are those of the
# wire formats and of the customer master.
# Fields of the JSON document a card transaction arrives as (message value).
TRANSACTION_PAYLOAD = StructType([
    *_strings("transaction_id", "customer_id", "card_number", "merchant_id",
              "merchant_name", "merchant_category"),
    StructField("amount", DoubleType()),
    *_strings("currency", "transaction_type", "payment_channel", "device_id",
              "city", "country"),
    StructField("transaction_timestamp", TimestampType()),
    StructField("is_international", BooleanType()),
    StructField("status", StringType()),
])

# Columns of a Kafka source row.
KAFKA_ENVELOPE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

# Watchlist records as delivered in JSON files and kept in the CSV feed.
# entity_id is a card number and must stay text; effective_from is text
# in the form dd-MMM-yyyy HH:mm:ss until the silver layer parses it.
WATCHLIST_RECORD = StructType(_strings(
    "watchlist_id", "entity_id", "watch_type", "risk_level", "action",
    "reason_code", "reason_description", "effective_from", "reported_by",
    "reported_source", "city", "country"))

# Where fields that the record does not declare, and lines that are no JSON
# object, are kept as text.
RESCUED = "rescued_data"

# Bronze watchlist: the records, what was rescued, the file each came from and when.
BRONZE_WATCHLIST = StructType(WATCHLIST_RECORD.fields + [
    StructField(RESCUED, StringType()),
    StructField("source_file", StringType()),
    StructField("ingestion_timestamp", TimestampType()),
])

# Customer master (bronze): account_open_date is still text here.
CUSTOMER = StructType([
    *_strings("customer_id", "first_name", "last_name", "gender"),
    StructField("age", IntegerType()),
    *_strings("city", "state", "country"),
    StructField("annual_income", MONEY),
    StructField("customer_segment", StringType()),
    StructField("account_open_date", StringType()),
    StructField("risk_score", IntegerType()),
    StructField("preferred_spending_min", MONEY),
    StructField("preferred_spending_max", MONEY),
    *_strings("preferred_city", "preferred_country", "trusted_device_id",
              "card_number", "card_type", "email"),
    StructField("transaction_limit", MONEY),
    StructField("update_timestamp", TimestampType()),
])

# One row per rendered notification.
OUTBOX = StructType([
    StructField("flow", StringType()),
    StructField("batch_id", LongType()),
    *_strings("recipient", "recipient_name", "subject", "body"),
    StructField("alert_count", LongType()),
])

# One row per line of a digest (its message is the outbox row of the same
# flow, batch and recipient).
OUTBOX_LINES = StructType([
    StructField("flow", StringType()),
    StructField("batch_id", LongType()),
    *_strings("recipient", "recipient_name", "alert_id", "row_html"),
])

# Expectation failures per table and micro-batch (partitioned by the last two).
QUALITY = StructType([
    StructField("expectation", StringType()),
    StructField("failed_rows", LongType()),
    StructField("total_rows", LongType()),
    StructField("table", StringType()),
    StructField("batch_id", LongType()),
])

# Input test tables of the driver (used by the adapter only).
EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])
