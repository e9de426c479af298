"""A gate in front of windowed counts that lists the rows a watermark shuts out.

A stateful aggregate drops rows of closed windows without a trace; its metric
counts partial aggregates, not rows.  The gate decides it for every input row:
a row is late if its window ended at or before the watermark, the latest event
time of the batches before its own less the delay.  Late rows go to one
ledger, all others to another; the counts then read the latter.  A count with
the same delay and windows of at least the gate's length drops none of those,
however it batches them, as its own watermark is never ahead of the gate's.

The latest event time is committed with each batch's rows, so a replayed batch
is judged as it was the first time.  Rows without an event time are let
through (windowed counts skip them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.gold import TUMBLING_WINDOW, WATERMARK_DELAY
from .ledger import Ledger

# The metric that holds a batch's latest event time, in milliseconds as watermarks are.
LATEST = "latest_event_ms"
GATE = "_late"


def watermark_before(table: Ledger, source: str, batch_id: int, delay: str = WATERMARK_DELAY) -> Column | None:
    """The watermark that a batch's rows are held against; none before the first event."""
    earlier = table.metrics().filter((F.col("source") == source) & (F.col("batch_id") < batch_id) &
                                     (F.col("metric") == LATEST))
    latest = earlier.agg(F.max("value")).first()[0]
    return None if latest is None else F.timestamp_millis(F.lit(latest)) - F.expr(f"INTERVAL {delay}")


def late_gate(on_time: Ledger, late: Ledger, source: str, event_time: str = "transaction_timestamp", *,
              window: str = TUMBLING_WINDOW, delay: str = WATERMARK_DELAY) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that deals each micro-batch to the two ledgers.

    The late rows are committed first; the batch is done with the commit of
    the others.  Either commit happens once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = on_time.on(spark)
        if table.committed(source, batch_id):
            return
        limit = watermark_before(table, source, batch_id, delay)
        if limit is not None:
            # F.window drops rows without a time, so they go round it.
            timed = F.col(event_time).isNotNull()
            ended = batch.filter(timed).withColumn(GATE, F.window(event_time, window)["end"] <= limit)
            late.on(spark).append(ended.filter(GATE).drop(GATE), source, batch_id)
            batch = ended.filter(~F.col(GATE)).drop(GATE).unionByName(batch.filter(~timed))
        seen = Observation()
        rows = batch.observe(seen, F.max(F.unix_millis(event_time)).alias(LATEST))

        def latest() -> dict[str, int]:
            value = seen.get[LATEST]
            return {} if value is None else {LATEST: value}

        table.append(rows, source, batch_id, latest)
    return handle
