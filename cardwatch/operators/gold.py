"""Gold layer: alerts and per-minute counts.

All functions take silver-shaped frames.  A transaction frame may be a
stream or a batch; the customer frame is a static snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import alert_id, full_name
from .joins import (DEFAULT_BROADCAST_BYTES, DEFAULT_SALT_BUCKETS, hot_key_salted_join,
                    join_dimension, salted_join)

# Event-time settings and alert type names.
WATERMARK_DELAY = "5 minutes"
TUMBLING_WINDOW = "1 minute"
SLIDING_WINDOW = "5 minutes"
SLIDING_SLIDE = "1 minute"
HIGH_VALUE = "HIGH_VALUE_TRANSACTION"
WATCHLIST_MATCH = "FRAUD_WATCHLIST_MATCH"

CUSTOMER_KEY = "_customer_key"


def transaction_counts(tx: DataFrame, window_duration: str = TUMBLING_WINDOW,
                       slide_duration: str | None = None,
                       watermark_delay: str = WATERMARK_DELAY) -> DataFrame:
    """Transactions per event-time window.

    On a stream the count of a window is emitted once, after the watermark
    (latest event time minus ``watermark_delay``) passes the window end;
    rows older than the watermark are dropped.  On a batch frame every
    window is returned.  Spark aggregates partially in each task before the
    shuffle by window, so a busy minute costs one row per task.
    """
    window = (F.window("transaction_timestamp", window_duration, slide_duration)
              if slide_duration else F.window("transaction_timestamp", window_duration))
    return (tx.select("transaction_timestamp")
            .withWatermark("transaction_timestamp", watermark_delay)
            .groupBy(window.alias("window"))
            .count()
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    F.col("count").alias("transactions_count")))


def sliding_transaction_counts(tx: DataFrame, watermark_delay: str = WATERMARK_DELAY) -> DataFrame:
    """Transactions per 5-minute window, one window starting every minute."""
    return transaction_counts(tx, SLIDING_WINDOW, SLIDING_SLIDE, watermark_delay)


def chained_sliding_counts(tx: DataFrame, watermark_delay: str = WATERMARK_DELAY) -> DataFrame:
    """Transactions per sliding window, added up from the counts per minute.

    Two aggregates in one query: every transaction makes one row of the first
    instead of one per window it lies in, and only minutes reach the second.
    On a stream a row whose minute is closed is dropped from all its windows,
    while ``sliding_transaction_counts`` still counts it in those that are
    open; without such rows (behind ``streaming.late.late_gate``) the two agree.
    """
    minutes = (tx.select("transaction_timestamp")
               .withWatermark("transaction_timestamp", watermark_delay)
               .groupBy(F.window("transaction_timestamp", TUMBLING_WINDOW).alias("minute"))
               .count())
    return (minutes.groupBy(F.window(F.window_time("minute"), SLIDING_WINDOW, SLIDING_SLIDE).alias("window"))
            .agg(F.sum("count").alias("count"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    F.col("count").alias("transactions_count")))


def customer_side(customers: DataFrame) -> DataFrame:
    """The customer columns an alert needs, keyed by ``_customer_key``."""
    return customers.select(
        F.col("customer_id").alias(CUSTOMER_KEY),
        F.col("email").alias("customer_email"),
        full_name("first_name", "last_name").alias("customer_name"),
        F.col("transaction_limit"),
    )


def with_customers(facts: DataFrame, customers: DataFrame, identity: list[str], *,
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                   salt_buckets: int = DEFAULT_SALT_BUCKETS,
                   hot_customers: DataFrame | None = None) -> DataFrame:
    """Inner join of facts with their customer (unknown customers drop out).

    ``hot_customers`` (a ``customer_id`` column, e.g. ``hot_keys`` of the
    transaction history) lets a stream split off busy customers when the
    customer table is too large to broadcast.  Duplicate customer ids
    multiply rows; pass ``latest_per_key(customers)`` to guard against that.
    """
    return join_dimension(facts, customer_side(customers), [("customer_id", CUSTOMER_KEY)],
                          identity, broadcast_bytes=broadcast_bytes,
                          salt_buckets=salt_buckets, hot=hot_customers).drop(CUSTOMER_KEY)


def high_value_transactions(tx: DataFrame, customers: DataFrame, **join_options) -> DataFrame:
    """Transactions above their customer's own limit, as alerts.

    ``amount`` (double) is compared with the decimal limit as a double; an
    amount equal to the limit, or NULL, is not an alert.
    """
    joined = with_customers(tx, customers, ["transaction_id"], **join_options)
    return joined.filter(F.col("amount") > F.col("transaction_limit")).select(
        alert_id("ALERT", "transaction_id").alias("alert_id"),
        F.lit(HIGH_VALUE).alias("alert_type"),
        F.current_timestamp().alias("alert_timestamp"),
        "transaction_id", "customer_id", "customer_email", "customer_name",
        F.col("amount").alias("transaction_amount"),
        "transaction_limit", "currency", "merchant_name", "merchant_category",
        "transaction_type", "payment_channel", "city", "country", "is_international",
        "transaction_timestamp", "status",
    )


def watchlist_side(watchlist: DataFrame) -> DataFrame:
    """Watchlist columns an alert needs, with location renamed."""
    return watchlist.select(
        "watchlist_id", "entity_id", "watch_type", "risk_level", "action", "reason_code",
        "reason_description", "effective_from", "reported_by", "reported_source",
        F.col("city").alias("watchlist_city"), F.col("country").alias("watchlist_country"),
    )


def watchlist_matches(tx: DataFrame, watchlist: DataFrame, *,
                      watermark_delay: str = WATERMARK_DELAY,
                      max_match_age: str | None = None,
                      salt_buckets: int = DEFAULT_SALT_BUCKETS,
                      broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                      hot_cards: DataFrame | None = None) -> DataFrame:
    """Transactions on a watch-listed card: ``card_number = entity_id``.

    Both sides carry a watermark.  By default there is no time condition,
    as in the original: an entry matches earlier and later transactions
    alike, and the join keeps its state for ever; with no time condition
    Spark has no state watermark either, so it drops no late rows (a
    back-dated entry still matches).  ``max_match_age`` (e.g. ``"30
    days"``) adds ``effective_from <= transaction_timestamp <=
    effective_from + age``, which lets Spark evict state and drop rows that
    arrive after the watermark; it changes the result and is opt-in.

    The transaction side is salted by a hash of ``transaction_id`` and the
    watchlist side repeated per salt, so one busy card is spread over
    ``salt_buckets`` state partitions.  With ``hot_cards`` (``card_number``
    and ``_buckets``, see ``joins.hot_keys``) only those cards are salted,
    each over as many partitions as its share needs.  Either way the salt
    layout is part of the join state: keep it fixed for a checkpoint.

    Two batch frames keep no state and are joined as with any dimension:
    the watchlist is broadcast if it fits, else only busy cards are salted.
    """
    if not tx.isStreaming and not watchlist.isStreaming and not max_match_age:
        return watchlist_matches_snapshot(tx, watchlist, broadcast_bytes=broadcast_bytes,
                                          salt_buckets=salt_buckets)
    t = tx.withWatermark("transaction_timestamp", watermark_delay)
    w = watchlist_side(watchlist).withWatermark("effective_from", watermark_delay)
    extra: Column | None = None
    if max_match_age:
        extra = ((F.col("transaction_timestamp") >= F.col("effective_from")) &
                 (F.col("transaction_timestamp") <=
                  F.col("effective_from") + F.expr(f"INTERVAL {max_match_age}")))
    on = [("card_number", "entity_id")]
    if hot_cards is not None:
        return hot_key_salted_join(t, w, on, hot_cards, ["transaction_id"],
                                   extra=extra).drop("entity_id")
    return salted_join(t, w, on, ["transaction_id"], salt_buckets, extra=extra).drop("entity_id")


def watchlist_matches_snapshot(tx: DataFrame, watchlist: DataFrame, *,
                               broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                               salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Transactions matched against the watchlist table as it is now.

    A stateless alternative to ``watchlist_matches``: the watchlist is a
    static snapshot (size-checked broadcast, else salted join), so nothing
    is kept in state and a back-dated entry is never lost to a watermark.
    The price: an entry matches only transactions processed after it was
    loaded, not earlier ones.
    """
    return join_dimension(tx, watchlist_side(watchlist), [("card_number", "entity_id")],
                          ["transaction_id"], broadcast_bytes=broadcast_bytes,
                          salt_buckets=salt_buckets).drop("entity_id")


def fraud_transactions(tx: DataFrame, watchlist: DataFrame, customers: DataFrame, *,
                       watermark_delay: str = WATERMARK_DELAY,
                       max_match_age: str | None = None,
                       salt_buckets: int = DEFAULT_SALT_BUCKETS,
                       broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                       watchlist_snapshot: bool = False,
                       hot_customers: DataFrame | None = None,
                       hot_cards: DataFrame | None = None) -> DataFrame:
    """One alert per (transaction, matching watchlist entry) of a known customer.

    ``watchlist_snapshot`` takes ``watchlist`` as a static table and matches
    with ``watchlist_matches_snapshot`` instead of the stream-stream join.
    """
    if watchlist_snapshot:
        matches = watchlist_matches_snapshot(tx, watchlist, broadcast_bytes=broadcast_bytes,
                                             salt_buckets=salt_buckets)
    else:
        matches = watchlist_matches(tx, watchlist, watermark_delay=watermark_delay,
                                    max_match_age=max_match_age, salt_buckets=salt_buckets,
                                    broadcast_bytes=broadcast_bytes, hot_cards=hot_cards)
    joined = with_customers(matches, customers, ["transaction_id", "watchlist_id"],
                            broadcast_bytes=broadcast_bytes, salt_buckets=salt_buckets,
                            hot_customers=hot_customers)
    return joined.select(
        alert_id("FRAUD", "transaction_id", "watchlist_id").alias("alert_id"),
        F.lit(WATCHLIST_MATCH).alias("alert_type"),
        F.current_timestamp().alias("alert_timestamp"),
        "transaction_id", "customer_id", "customer_email", "customer_name", "card_number",
        "amount", "currency", "merchant_id", "merchant_name", "merchant_category",
        "transaction_type", "payment_channel", "device_id",
        F.col("city").alias("transaction_city"), F.col("country").alias("transaction_country"),
        "transaction_timestamp", "is_international",
        F.col("status").alias("transaction_status"),
        "watchlist_id", "watch_type", "risk_level", "action", "reason_code",
        "reason_description", F.col("effective_from").alias("watchlist_effective_from"),
        "reported_by", "reported_source", "watchlist_city", "watchlist_country",
    )
