"""Matching two growing tables without join state.

A step joins what is new on either side since the last one::

    new transactions      x  all watchlist entries
    earlier transactions  x  new watchlist entries

so every pair is found once, whichever side came first and whatever the gap,
and nothing is kept but the two tables themselves and, in the result's log,
the versions a step has taken.  Those are committed with the step's rows: a
step that dies is done again, a step that is repeated finds nothing new.

Transactions lie in partitions of event date and card bucket.  New entries
choose the buckets of the earlier transactions to scan; with a greatest age
of matches they choose the dates as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from ..operators.current import bucket_of
from ..operators.gold import watchlist_side
from ..operators.joins import DEFAULT_BROADCAST_BYTES, join_dimension
from .ledger import Ledger

EVENT_DATE, CARD_BUCKET = "event_date", "card_bucket"
CARD_BUCKETS = 16
SOURCE = "delta"


def transaction_ledger(spark: SparkSession, root: str, schema: StructType) -> Ledger:
    """Transactions by event date and card bucket."""
    fields = [*schema.fields, StructField(EVENT_DATE, DateType()), StructField(CARD_BUCKET, IntegerType())]
    return Ledger(spark, root, StructType(fields), (EVENT_DATE, CARD_BUCKET), writers=1).create()


def placed(tx: DataFrame, buckets: int = CARD_BUCKETS) -> DataFrame:
    """Transactions with the columns that place them."""
    return (tx.withColumn(EVENT_DATE, F.to_date("transaction_timestamp"))
            .withColumn(CARD_BUCKET, bucket_of("card_number", buckets)))


def _taken(result: Ledger) -> tuple[int, int, int]:
    """(steps done, version of the transactions, version of the entries) of the committed steps."""
    rows = {r["metric"]: r["value"] for r in result.metrics().groupBy("metric").agg(
        F.max("value").alias("value")).collect()}
    steps = result.commits().agg(F.max("batch_id")).first()[0]
    return 0 if steps is None else steps + 1, rows.get("transactions", 0), rows.get("entries", 0)


def match_step(tx: Ledger, watchlist: Ledger, result: Ledger, *, max_match_age: str | None = None,
               buckets: int = CARD_BUCKETS, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               finish=lambda matches: matches) -> int:
    """One step; returns the number of steps done so far.

    ``finish`` turns matches (transaction columns and those of
    ``gold.watchlist_side`` but the card) into rows of ``result``.
    """
    steps, tx_seen, entries_seen = _taken(result)
    tx_now, entries_now = tx.version(), watchlist.version()
    if (tx_now, entries_now) == (tx_seen, entries_seen):
        return steps
    on, identity = [("card_number", "entity_id")], ["transaction_id"]
    new_tx = tx.read(since=tx_seen, upto=tx_now)
    all_entries = watchlist_side(watchlist.read(upto=entries_now))
    matches = join_dimension(new_tx, all_entries, on, identity, broadcast_bytes=broadcast_bytes)
    if tx_seen and entries_now > entries_seen:
        new_entries = watchlist_side(watchlist.read(since=entries_seen, upto=entries_now))
        earlier = tx.read(upto=tx_seen).filter(earlier_than(new_entries, max_match_age, buckets))
        matches = matches.unionByName(join_dimension(earlier, new_entries, on, identity,
                                                     broadcast_bytes=broadcast_bytes))
    if max_match_age:
        matches = matches.filter(F.col("transaction_timestamp").between(
            F.col("effective_from"), F.col("effective_from") + F.expr(f"INTERVAL {max_match_age}")))
    matches = matches.drop("entity_id", EVENT_DATE, CARD_BUCKET)
    result.append(finish(matches), SOURCE, steps,
                  lambda: {"transactions": tx_now, "entries": entries_now})
    return steps + 1


def earlier_than(new_entries: DataFrame, max_match_age: str | None, buckets: int) -> Column:
    """The partitions of transactions that new entries can match: at most a row per bucket is asked for."""
    rows = new_entries.groupBy(bucket_of("entity_id", buckets).alias("bucket")).agg(
        F.to_date(F.min("effective_from")).alias("low"), *([] if not max_match_age else [
            F.to_date(F.max(F.col("effective_from") + F.expr(f"INTERVAL {max_match_age}"))).alias("high")])).collect()
    where = F.col(CARD_BUCKET).isin([r["bucket"] for r in rows if r["bucket"] is not None])
    if max_match_age:
        timed = [r for r in rows if r["low"] is not None]
        if not timed:
            return F.lit(False)
        where = where & F.col(EVENT_DATE).between(min(r["low"] for r in timed), max(r["high"] for r in timed))
    return where
