"""Streaming behaviour: late rows, join state, retries, batch/stream parity."""

import json
import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cardwatch.config import new_run
from cardwatch.operators import alerts, gold
from cardwatch.sources import testdata
from cardwatch.streaming import runner

TX_JSON_SCHEMA = "transaction_id string, card_number string, transaction_timestamp timestamp"
WL_JSON_SCHEMA = "watchlist_id string, entity_id string, effective_from timestamp"


def stage(folder, batches):
    """One JSON-lines file per batch, with increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(path, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))


def ts(hms):
    return f"2024-01-01 {hms}"


def test_late_rows_lag_one_batch(spark, tmp_path):
    folder = str(tmp_path / "tx")
    stage(folder, [
        [{"transaction_id": "a", "transaction_timestamp": ts("10:00:30")},
         {"transaction_id": "b", "transaction_timestamp": ts("10:10:00")}],
        [{"transaction_id": "c", "transaction_timestamp": ts("10:01:00")},
         {"transaction_id": "d", "transaction_timestamp": ts("10:20:00")}],
        [{"transaction_id": "e", "transaction_timestamp": ts("10:02:00")},
         {"transaction_id": "f", "transaction_timestamp": ts("10:06:00")},
         {"transaction_id": "g", "transaction_timestamp": ts("10:15:30")}],
    ])
    stream = (spark.readStream.schema(TX_JSON_SCHEMA).option("maxFilesPerTrigger", 1)
              .json(folder))
    run = new_run(spark, "test_late")
    progress = runner.run_to_table(gold.transaction_counts(stream), run.table("c"),
                                   run.checkpoint("c"))
    got = sorted((r.window_start.strftime("%H:%M"), r.transactions_count)
                 for r in spark.read.parquet(run.table("c")).collect())
    assert got == [("10:00", 1), ("10:01", 1), ("10:06", 1), ("10:10", 1)]
    assert runner.rows_dropped_by_watermark(progress) == 1


def _backdated_run(spark, tmp_path, name, max_match_age):
    tx_dir, wl_dir = str(tmp_path / f"{name}_tx"), str(tmp_path / f"{name}_wl")
    stage(tx_dir, [
        [{"transaction_id": "t1", "card_number": "A", "transaction_timestamp": ts("10:00:00")}],
        [{"transaction_id": "t2", "card_number": "B", "transaction_timestamp": ts("11:00:00")}],
        [{"transaction_id": "t3", "card_number": "C", "transaction_timestamp": ts("11:01:00")}],
        [{"transaction_id": "t4", "card_number": "C", "transaction_timestamp": ts("11:02:00")}],
    ])
    stage(wl_dir, [
        [{"watchlist_id": "W1", "entity_id": "B", "effective_from": ts("10:00:00")}],
        [{"watchlist_id": "W2", "entity_id": "Z", "effective_from": ts("11:00:00")}],
        [{"watchlist_id": "W3", "entity_id": "C", "effective_from": ts("11:01:00")}],
        # back-dated: arrives when the watermark is already 10:55
        [{"watchlist_id": "W4", "entity_id": "A", "effective_from": ts("10:00:00")}],
    ])
    t = spark.readStream.schema(TX_JSON_SCHEMA).option("maxFilesPerTrigger", 1).json(tx_dir)
    w = (spark.readStream.schema(WL_JSON_SCHEMA).option("maxFilesPerTrigger", 1).json(wl_dir)
         .withColumn("watch_type", F.lit("CARD")))
    for c in ["risk_level", "action", "reason_code", "reason_description", "reported_by",
              "reported_source", "city", "country"]:
        w = w.withColumn(c, F.lit(None).cast("string"))
    matches = gold.watchlist_matches(t.withColumn("city", F.lit("x")), w,
                                     max_match_age=max_match_age).select(
        "transaction_id", "watchlist_id")
    run = new_run(spark, name)
    progress = runner.run_to_table(matches, run.table("m"), run.checkpoint("m"))
    got = sorted((r.transaction_id, r.watchlist_id)
                 for r in spark.read.parquet(run.table("m")).collect())
    return got, progress


def test_unbounded_match_keeps_all_state(spark, tmp_path):
    """Without a time condition Spark can neither evict nor drop late rows:
    an entry dated before its transaction matches, and so does a back-dated
    entry arriving long after the watermark passed it."""
    got, progress = _backdated_run(spark, tmp_path, "unbounded", None)
    assert got == [("t1", "W4"), ("t2", "W1"), ("t3", "W3"), ("t4", "W3")]
    assert runner.rows_dropped_by_watermark(progress) == 0
    totals = [sum(op.numRowsTotal for op in p.stateOperators) for p in progress]
    assert totals == sorted(totals) and totals[-1] > totals[0]     # state only grows


def test_time_bounded_match_drops_late_entries(spark, tmp_path):
    """With max_match_age the join has a state watermark: the back-dated
    entry is late and dropped (the opt-in variant changes results)."""
    got, progress = _backdated_run(spark, tmp_path, "bounded", "2 hours")
    assert got == [("t2", "W1"), ("t3", "W3"), ("t4", "W3")]
    assert runner.rows_dropped_by_watermark(progress) > 0


def test_outbox_retry_replaces_its_own_batch(spark, sf_dir, tmp_path):
    events = testdata.read_table(spark, sf_dir, "events")
    path = str(tmp_path / "gold_hv")
    from cardwatch.plans.catalog import _customers
    gold.high_value_transactions(testdata.transactions(events), _customers(spark, sf_dir)) \
        .write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    run = new_run(spark, "test_retry")
    sink = alerts.outbox_sink(run.table("outbox"), "high_value", alerts.high_value_messages)
    flag = tmp_path / "failed_once"

    def failing_once(batch, batch_id):
        sink(batch, batch_id)                  # the write happened ...
        if not flag.exists():
            flag.write_text("x")
            raise RuntimeError("mail relay down")  # ... then the batch fails

    with pytest.raises(StreamingQueryException):
        runner.finish(runner.start_foreach_batch(stream, failing_once, run.checkpoint("outbox")), spark)
    runner.finish(runner.start_foreach_batch(stream, failing_once, run.checkpoint("outbox")), spark)
    out = spark.read.parquet(run.table("outbox"))
    expected = spark.read.parquet(path).count()
    assert out.count() == expected
    assert out.select("batch_id").distinct().count() == 1


def test_counts_batch_and_stream_agree_on_closed_windows(spark, sf_dir):
    run = new_run(spark, "test_parity")
    stream = testdata.transactions(testdata.events_stream(spark, sf_dir, partitions=4))
    runner.run_to_table(gold.sliding_transaction_counts(stream), run.table("s"),
                        run.checkpoint("s"))
    streamed = spark.read.parquet(run.table("s"))
    batch = gold.sliding_transaction_counts(
        testdata.transactions(testdata.read_table(spark, sf_dir, "events")))
    assert streamed.exceptAll(batch).count() == 0      # every emitted window is final
    missing = batch.exceptAll(streamed)
    latest = streamed.agg(F.max("window_end")).first()[0]
    assert missing.filter(F.col("window_end") <= latest).count() == 0
    # each row is counted in five windows
    total = batch.agg(F.sum("transactions_count")).first()[0]
    assert total == 5 * testdata.read_table(spark, sf_dir, "events").count()


def test_registered_late_query_drops_the_older_half(spark, sf_dir):
    from cardwatch.plans import catalog
    windows = catalog.QUERIES["late_rows_dropped"](spark, sf_dir)
    events = testdata.read_table(spark, sf_dir, "events")
    older = events.filter(F.col("ts") < F.lit(catalog.DELIVERED_BEFORE).cast("timestamp_ntz"))
    # the metric counts rows reaching the stateful operator: partial counts,
    # one per minute and task, so at most the number of late rows
    dropped = runner.rows_dropped_by_watermark(catalog.PROGRESS["late_rows_dropped"])
    assert 0 < dropped <= older.count()
    assert windows.agg(F.min("window_start")).first()[0] >= \
        datetime.fromisoformat(catalog.DELIVERED_BEFORE)
