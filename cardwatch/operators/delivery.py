"""What became of the outbox's messages: an acknowledgement log of the sender.

The sender appends one row per attempt: the message, whether it was
``delivered`` or ``failed``, and when.  A message is delivered once any
attempt was, failed while all its attempts did, pending without one; so
acknowledgements may be repeated and come in any order, and rows about unknown
messages change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from ..schemas import OUTBOX, OUTBOX_LINES
from ..streaming.ledger import Ledger

DELIVERED, FAILED, PENDING = "delivered", "failed", "pending"
MESSAGE, LINE = "message", "line"
ACKNOWLEDGEMENT = StructType([StructField("message_id", StringType()), StructField("status", StringType()),
                              StructField("acknowledged_at", TimestampType())])
# Messages and their lines in one table: all fields of both, what a row is, and the day it was written.
OUTBOX_ROWS = StructType([*OUTBOX.fields, *[f for f in OUTBOX_LINES.fields if f.name not in OUTBOX.names],
                          StructField("kind", StringType()), StructField("day", DateType())])


def outbox_ledger(spark: SparkSession, root: str) -> Ledger:
    """Both flows' messages and lines: a folder per kind, flow and day, whatever the number of batches."""
    return Ledger(spark, root, OUTBOX_ROWS, ("kind", "flow", "day")).create()


def acknowledgement_ledger(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, root, ACKNOWLEDGEMENT).create()


def message_id() -> Column:
    """The id of an outbox message, from what tells it from all others."""
    return F.md5(F.to_json(F.array("flow", F.col("batch_id").cast("string"), "recipient", "subject")))


def _rows(rows: DataFrame, kind: str, flow: str, batch_id: int) -> DataFrame:
    tagged = (rows.withColumn("flow", F.lit(flow)).withColumn("batch_id", F.lit(batch_id))
              .withColumn("kind", F.lit(kind)).withColumn("day", F.current_date()))
    return tagged.select([(F.col(f.name) if f.name in tagged.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in OUTBOX_ROWS.fields])


def indexed_sink(outbox: Ledger, flow: str, render, render_lines=None):
    """A ``foreachBatch`` handler: one write and one commit per batch of alerts, digests with their lines."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = _rows(render(batch), MESSAGE, flow, batch_id)
        if render_lines is not None:
            rows = rows.unionByName(_rows(render_lines(batch), LINE, flow, batch_id))
        outbox.on(batch.sparkSession).append(rows, flow, batch_id)
    return handle


def messages(outbox: Ledger) -> DataFrame:
    return outbox.read().filter(F.col("kind") == MESSAGE).select(OUTBOX.names)


def lines(outbox: Ledger) -> DataFrame:
    return outbox.read().filter(F.col("kind") == LINE).select(OUTBOX_LINES.names)


def outcomes(acknowledgements: DataFrame) -> DataFrame:
    """``(message_id, status)``, one row per acknowledged message."""
    return (acknowledgements.filter(F.col("status").isin(DELIVERED, FAILED)).groupBy("message_id")
            .agg(F.when(F.max(F.col("status") == DELIVERED), DELIVERED).otherwise(FAILED).alias("status")))


def unsent(outbox: DataFrame, acknowledgements: DataFrame, *, retry_failed: bool = False) -> DataFrame:
    """Messages without an acknowledgement; with ``retry_failed`` those that failed as well."""
    done = outcomes(acknowledgements)
    if retry_failed:
        done = done.filter(F.col("status") == DELIVERED)
    return outbox.withColumn("message_id", message_id()).join(done.select("message_id"), "message_id", "left_anti")


def delivery_tally(outbox: DataFrame, acknowledgements: DataFrame) -> DataFrame:
    """Messages per flow and batch, and how many are delivered, failed and pending."""
    known = (outbox.select("flow", "batch_id", message_id().alias("message_id"))
             .join(outcomes(acknowledgements), "message_id", "left")
             .withColumn("status", F.coalesce("status", F.lit(PENDING))))
    return known.groupBy("flow", "batch_id").agg(
        F.count(F.lit(1)).alias("messages"),
        *[F.count_if(F.col("status") == s).alias(s) for s in (DELIVERED, FAILED, PENDING)])
