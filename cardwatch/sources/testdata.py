"""Adapter from the driver's test tables to the pipeline's domain tables.

``events`` stands for card transactions (and, for its large ``error``
rows, for watchlist entries); ``customer`` with ``nation`` stands for the
customer master.  Every derived attribute is a plain column expression of
the input row, so the mapping works the same on a batch frame and on a
stream, and the DuckDB oracle can state it in SQL (plans/oracle.py
mirrors each expression).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import WATCHLIST_TIME_FORMAT, event_time
from ..schemas import EVENTS, TRANSACTION_PAYLOAD

# Fixed values of the mapping (the oracle SQL repeats them).
TOPIC = "transactions"
CURRENCY = "USD"
# Watchlist entries are error events above this value.
WATCHLIST_MIN_VALUE = 150.0
# JSON layout of the replayed message value.
JSON_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_stream(spark: SparkSession, sf_dir: str, *, max_files_per_trigger: int | None = None,
                  partitions: int | None = None) -> DataFrame:
    """The ``events`` table of a scale-factor folder, read as a file stream.

    ``partitions`` spreads each micro-batch over that many tasks, as the
    partitions of a Kafka topic would (a file with one row group is
    otherwise read by a single task).
    """
    reader = (spark.readStream.schema(EVENTS)
              .option("pathGlobFilter", "events.parquet"))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(sf_dir)
    return stream.repartition(partitions) if partitions else stream


def card_number(user_id: Column) -> Column:
    """16-digit card number of a user: ``4`` and the id padded to 15 digits."""
    return F.concat(F.lit("4"), F.lpad(user_id.cast("string"), 15, "0"))


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _transaction_columns() -> dict[str, Column]:
    """The 16 payload fields as expressions over an ``events`` row."""
    k = _props_k()
    return {
        "transaction_id": F.concat(F.lit("T"), F.col("event_id").cast("string")),
        "customer_id": F.col("user_id").cast("string"),
        "card_number": card_number(F.col("user_id")),
        "merchant_id": F.concat(F.lit("M"), k.cast("string")),
        "merchant_name": F.concat(F.lit("Merchant "), k.cast("string")),
        "merchant_category": F.when(k % 4 == 0, "grocery").when(k % 4 == 1, "electronics")
                              .when(k % 4 == 2, "travel").otherwise("dining"),
        "amount": F.col("value"),
        "currency": F.lit(CURRENCY),
        "transaction_type": F.col("event_type"),
        "payment_channel": F.when(k % 2 == 0, "online").otherwise("pos"),
        "device_id": F.concat(F.lit("DEV"), F.col("user_id").cast("string")),
        "city": F.concat(F.lit("City "), (F.col("user_id") % 12).cast("string")),
        "country": F.when(k >= 90, "GB").otherwise("US"),
        "transaction_timestamp": event_time("ts"),
        "is_international": k >= 90,
        "status": F.when(F.col("event_type") == "error", "declined").otherwise("approved"),
    }


def transactions(events: DataFrame) -> DataFrame:
    """Silver-shaped transactions (the 16 payload fields) from ``events``."""
    return events.select([c.alias(n) for n, c in _transaction_columns().items()])


def dirty_transactions(events: DataFrame) -> DataFrame:
    """Transactions with missing customer ids and negative amounts mixed in.

    Every 7th event loses its customer id, every 11th has its amount
    negated; used to exercise the expectations on the whole table.
    """
    cols = _transaction_columns()
    cols["customer_id"] = F.when(F.col("event_id") % 7 != 0, cols["customer_id"])
    cols["amount"] = F.when(F.col("event_id") % 11 == 0, -F.col("value")).otherwise(F.col("value"))
    return events.select([c.alias(n) for n, c in cols.items()])


def kafka_envelope(events: DataFrame, *, malformed: bool = False) -> DataFrame:
    """Kafka-shaped rows whose value is the JSON of ``transactions(events)``.

    With ``malformed`` every 13th value is not JSON at all and the one after
    it carries the amount as a quoted string, to exercise parsing.
    """
    cols = _transaction_columns()
    payload = F.to_json(F.struct(*[cols[f.name].alias(f.name) for f in TRANSACTION_PAYLOAD.fields]),
                        {"timestampFormat": JSON_TIME_FORMAT, "ignoreNullFields": "false"})
    value = payload
    if malformed:
        eid = F.col("event_id")
        value = (F.when(eid % 13 == 0, F.lit("not json"))
                 .when(eid % 13 == 1,
                       F.regexp_replace(payload, r'"amount":([-0-9.Ee]+)', '"amount":"$1"'))
                 .otherwise(payload))
    return events.select(
        cols["transaction_id"].cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        event_time("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """The 22-column customer master (bronze) from ``customer`` and ``nation``.

    The nation join is a left join on a 25-row reference table; Spark
    broadcasts it by its own size statistics.
    """
    key = F.col("c_custkey")
    name_parts = F.split(F.col("c_name"), "#")
    acctbal = F.col("c_acctbal").cast("decimal(18,2)")
    spending_min = ((key % 50) * 100).cast("decimal(18,2)")
    open_date = F.date_format(F.date_add(F.lit("2015-01-01").cast("date"),
                                         (key % 3650).cast("int")), "yyyy-MM-dd")
    city = F.concat(F.lit("City "), (key % 12).cast("string"))
    c = customer.alias("c").join(nation.alias("n"), F.col("c.c_nationkey") == F.col("n.n_nationkey"),
                                 "left")
    return c.select(
        key.cast("string").alias("customer_id"),
        name_parts.getItem(0).alias("first_name"),
        name_parts.getItem(1).alias("last_name"),
        F.when(key % 3 == 0, "Female").when(key % 3 == 1, "Male").otherwise("Other").alias("gender"),
        (18 + key % 58).cast("int").alias("age"),
        city.alias("city"),
        F.concat(F.lit("State "), F.col("n.n_regionkey").cast("string")).alias("state"),
        F.col("n.n_name").alias("country"),
        (acctbal * 12).cast("decimal(18,2)").alias("annual_income"),
        F.col("c_mktsegment").alias("customer_segment"),
        # every 101st open date is not a calendar date, to exercise parsing
        F.when(key % 101 == 100, F.lit("2020-02-30")).otherwise(open_date).alias("account_open_date"),
        (key % 100).cast("int").alias("risk_score"),
        spending_min.alias("preferred_spending_min"),
        (spending_min + 5000).cast("decimal(18,2)").alias("preferred_spending_max"),
        city.alias("preferred_city"),
        F.col("n.n_name").alias("preferred_country"),
        F.concat(F.lit("DEV"), key.cast("string")).alias("trusted_device_id"),
        card_number(key).alias("card_number"),
        F.when(key % 4 == 0, "Visa").when(key % 4 == 1, "Mastercard")
         .when(key % 4 == 2, "Amex").otherwise("RuPay").alias("card_type"),
        F.lower(F.concat(F.regexp_replace(F.col("c_name"), "#", "."), F.lit("@example.com")))
         .alias("email"),
        acctbal.alias("transaction_limit"),
        # wall-clock time, so the value does not depend on the session zone
        F.timestamp_add("SECOND", key, F.to_timestamp(F.lit("2024-01-01 00:00:00")))
         .alias("update_timestamp"),
    )


def watchlist_records(events: DataFrame) -> DataFrame:
    """Watchlist entries (JSON/CSV record layout) from large ``error`` events."""
    v = F.col("value")
    risk = F.when(v > 400, "high").when(v > 250, "medium").otherwise("low")
    return (events.filter((F.col("event_type") == "error") & (v > WATCHLIST_MIN_VALUE))
            .select(
                F.format_string("WL%06d", F.col("event_id")).alias("watchlist_id"),
                card_number(F.col("user_id")).alias("entity_id"),
                F.lit("CARD").alias("watch_type"),
                risk.alias("risk_level"),
                F.when(v > 400, "block").when(v > 250, "review").otherwise("monitor").alias("action"),
                F.concat(F.lit("R"), (F.col("event_id") % 5).cast("string")).alias("reason_code"),
                F.lit("large error event").alias("reason_description"),
                F.date_format(F.col("ts"), WATCHLIST_TIME_FORMAT).alias("effective_from"),
                F.lit("monitoring").alias("reported_by"),
                F.lit("events").alias("reported_source"),
                F.concat(F.lit("City "), (F.col("user_id") % 12).cast("string")).alias("city"),
                F.lit("US").alias("country"),
            ))
