"""Registered queries: each takes ``(spark, sf_dir)`` and returns a frame.

Streaming queries run for real: the test tables are read as file streams,
the query runs with an availableNow trigger into a fresh folder below the
shared checkpoint folder, and the frame returned reads that output back.
Columns that hold the wall-clock time of processing (``*_ingestion_*``,
``alert_timestamp``) are left out of what is returned, so results can be
compared with an independent SQL engine; timestamps come back as
``timestamp_ntz`` like the input tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunFolder, is_local, new_run
from ..functions.expressions import wall_clock
from ..operators import alerts, bronze, current, delivery, feed, gold, silver
from ..operators.quality import apply_expectations, expectation_report, observed_expectations
from ..schemas import CUSTOMER, WATCHLIST_RECORD
from ..sources import files, testdata
from ..streaming import delta, pipeline
from ..streaming.evolving import EvolvingTable
from ..streaming.late import late_gate
from ..streaming.ledger import Ledger
from ..streaming.runner import finish, run_to_table, start_foreach_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Progress reports of the streaming queries of the latest run of each key
# (for the bench: batches, input rows, state size).
PROGRESS: dict[str, list] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# Event time splitting the test data into an older and a newer half (the
# watchlist feed takes the older half as already delivered).
DELIVERED_BEFORE = "2024-01-16 00:00:00"

# Bytes of a row group of the staged events; a scan cannot be split further.
STAGED_ROW_GROUP = 4 * 1024 * 1024

# Files of the staged watchlist feed.
FEED_PARTS = 20

# Hash buckets of the test tables (a cluster's tables have more).
CARD_BUCKETS, CUSTOMER_BUCKETS = 4, 8

# Columns holding the processing time, left out of returned results.
PROCESSING_TIME = ("ingestion_timestamp", "bronze_ingestion_timestamp",
                   "silver_ingestion_timestamp", "alert_timestamp")


def _cores(spark: SparkSession) -> int:
    """Cores of the session: the partitions of the test-table streams.

    The test tables are small, so their streaming queries keep one state
    partition per core rather than the session's shuffle partitions (a
    cluster job sizes those for its own state).
    """
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext on Spark Connect
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _stream_result(spark: SparkSession, name: str, df: DataFrame, *,
                   run: RunFolder | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream to the end of its input and read back what it wrote."""
    run = run or new_run(spark, name)
    PROGRESS[name] = run_to_table(df, run.table(name), run.checkpoint(name),
                                  partitions=_cores(spark))
    out = spark.read.parquet(run.table(name))
    return wall_clock(out.drop(*PROCESSING_TIME, *drop))


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream spread over the session's cores, like a
    partitioned topic."""
    return testdata.events_stream(spark, sf_dir, partitions=_cores(spark))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.read_table(spark, sf_dir, "events")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver customers snapshot, as the gold queries read it."""
    raw = testdata.customers(testdata.read_table(spark, sf_dir, "customer"),
                             testdata.read_table(spark, sf_dir, "nation"))
    return silver.silver_customers(bronze.bronze_customers(raw))


def _stage_watchlist(spark: SparkSession, sf_dir: str, run: RunFolder) -> str:
    """Write the watchlist records derived from ``events`` as JSON files."""
    folder = run.staging("watchlist_drop")
    testdata.watchlist_records(_events(spark, sf_dir)).write.json(folder)
    return folder


def _silver_watchlist_stream(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_watchlist(bronze.bronze_watchlist(files.watchlist_stream(spark, folder)))


# -- gold: counts per event-time window -------------------------------------

@query("tumbling_count")
def tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-minute counts of a transaction stream; closed windows only."""
    tx = testdata.transactions(_events_stream(spark, sf_dir))
    return _stream_result(spark, "tumbling_count", gold.transaction_counts(tx))


@query("sliding_count")
def sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute windows every minute over a transaction stream; closed only."""
    tx = testdata.transactions(_events_stream(spark, sf_dir))
    return _stream_result(spark, "sliding_count", gold.sliding_transaction_counts(tx))


@query("sliding_count_chained")
def sliding_count_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sliding windows of a transaction stream from its counts per minute; closed only."""
    tx = testdata.transactions(_events_stream(spark, sf_dir))
    return _stream_result(spark, "sliding_count_chained", gold.chained_sliding_counts(tx))


@query("late_rows_dropped")
def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-minute counts when the older half of the data arrives late.

    The newer half of ``events`` is delivered and counted first; then the
    older half arrives and the same query (same checkpoint) runs again.
    Every older row is behind the watermark by then and is dropped, so the
    emitted windows are those of the newer half.
    """
    run = new_run(spark, "late_rows_dropped")
    folder, table = run.staging("transactions"), run.table("late_rows_dropped")
    events = _events(spark, sf_dir)
    cutoff = F.lit(DELIVERED_BEFORE).cast("timestamp_ntz")
    progress = []
    for part in (events.filter(F.col("ts") >= cutoff), events.filter(F.col("ts") < cutoff)):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        progress += run_to_table(gold.transaction_counts(testdata.transactions(stream)), table,
                                 run.checkpoint("late_rows_dropped"), partitions=_cores(spark))
    PROGRESS["late_rows_dropped"] = progress
    return wall_clock(spark.read.parquet(table))


@query("tumbling_count_batch")
def tumbling_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per-minute count on a batch frame: every window."""
    tx = testdata.transactions(testdata.read_table(spark, sf_dir, "events"))
    return wall_clock(gold.transaction_counts(tx))


@query("sliding_count_batch")
def sliding_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sliding count on a batch frame: every window."""
    tx = testdata.transactions(testdata.read_table(spark, sf_dir, "events"))
    return wall_clock(gold.sliding_transaction_counts(tx))


# -- bronze and silver transactions -----------------------------------------

@query("bronze_transactions")
def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped stream landed with key and value as text."""
    envelope = testdata.kafka_envelope(_events_stream(spark, sf_dir))
    return _stream_result(spark, "bronze_transactions", bronze.bronze_transactions(envelope))


@query("silver_transactions")
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze stream parsed, flattened and checked by the expectations."""
    envelope = testdata.kafka_envelope(_events_stream(spark, sf_dir))
    return _stream_result(spark, "silver_transactions",
                          silver.silver_transactions(bronze.bronze_transactions(envelope)))


@query("json_parse")
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permissive parse of message values, some of them malformed."""
    envelope = testdata.kafka_envelope(_events(spark, sf_dir), malformed=True)
    return wall_clock(silver.parse_transactions(bronze.bronze_transactions(envelope))
                      .drop(*PROCESSING_TIME))


# -- expectations --------------------------------------------------------------

@query("expect_or_drop")
def expect_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by the drop expectations (missing ids removed)."""
    dirty = testdata.dirty_transactions(_events(spark, sf_dir))
    return wall_clock(apply_expectations(dirty, silver.TRANSACTION_EXPECTATIONS))


@query("expect_warn")
def expect_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warn expectation keeps every row, failing or not."""
    dirty = testdata.dirty_transactions(_events(spark, sf_dir))
    warn_only = [e for e in silver.TRANSACTION_EXPECTATIONS if e.action == "warn"]
    return wall_clock(apply_expectations(dirty, warn_only))


@query("expectation_metrics")
def expectation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure count of every expectation over all input rows."""
    dirty = testdata.dirty_transactions(_events(spark, sf_dir))
    return expectation_report(dirty, silver.TRANSACTION_EXPECTATIONS)


# -- customers -------------------------------------------------------------------

@query("bronze_customers")
def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed 22-column customer master."""
    raw = testdata.customers(testdata.read_table(spark, sf_dir, "customer"),
                             testdata.read_table(spark, sf_dir, "nation"))
    return wall_clock(bronze.bronze_customers(raw).drop(*PROCESSING_TIME))


@query("silver_customers")
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze customer table read as a stream, checked, open date parsed."""
    run = new_run(spark, "silver_customers")
    raw = testdata.customers(testdata.read_table(spark, sf_dir, "customer"),
                             testdata.read_table(spark, sf_dir, "nation"))
    bronze.bronze_customers(raw).write.parquet(run.table("bronze_customers"))
    stream = files.table_stream(spark, run.table("bronze_customers"))
    return _stream_result(spark, "silver_customers", silver.silver_customers(stream), run=run)


# -- gold: stream-static join ----------------------------------------------------------

@query("stream_static_join")
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction stream joined with the customer snapshot."""
    tx = testdata.transactions(_events_stream(spark, sf_dir))
    joined = gold.with_customers(tx, _customers(spark, sf_dir), ["transaction_id"])
    return _stream_result(spark, "stream_static_join", joined.select(
        "transaction_id", "customer_id", "amount", "transaction_limit", "customer_email",
        "customer_name"))


@query("high_value_transactions")
def high_value_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts for transactions above the customer's own limit."""
    tx = testdata.transactions(_events_stream(spark, sf_dir))
    return _stream_result(spark, "high_value_transactions",
                          gold.high_value_transactions(tx, _customers(spark, sf_dir)))


# -- watchlist ---------------------------------------------------------------------------

@query("bronze_watchlist")
def bronze_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist files landed as they are (file path left out)."""
    run = new_run(spark, "bronze_watchlist")
    folder = _stage_watchlist(spark, sf_dir, run)
    stream = bronze.bronze_watchlist(files.watchlist_stream(spark, folder))
    return _stream_result(spark, "bronze_watchlist", stream, run=run, drop=("source_file",))


@query("source_file_lineage")
def source_file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze watchlist rows, and what the file each came from is like.

    The path itself differs from run to run, so the result says whether the
    file lies in the drop folder and is named like a delivered part.
    """
    run = new_run(spark, "source_file_lineage")
    folder = _stage_watchlist(spark, sf_dir, run)
    stream = bronze.bronze_watchlist(files.watchlist_stream(spark, folder))
    out = _stream_result(spark, "source_file_lineage", stream, run=run)
    inside = folder.removeprefix("file://").lstrip("/") + "/"
    return (out.withColumn("in_drop_folder", F.col("source_file").contains(inside))
            .withColumn("is_part_file", F.regexp_like("source_file", F.lit(r"/part-[^/]*\.json$")))
            .drop("source_file"))


@query("watchlist_rescued")
def watchlist_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze watchlist from files with undeclared fields and lines that are no JSON.

    Every third record has two more fields, every fifth is cut off in the
    middle; the files are named like nothing in particular.
    """
    run = new_run(spark, "watchlist_rescued")
    folder = run.staging("watchlist_drop")
    records = testdata.watchlist_records(_events(spark, sf_dir))
    number = F.substring("watchlist_id", 3, 20).cast("long")
    plain = F.to_json(F.struct(*records.columns))
    more = F.to_json(F.struct(*records.columns, F.lit("eu").alias("region"),
                              number.alias("batch")))
    line = (F.when(number % 5 == 0, F.substring(plain, 1, 30))
            .when(number % 3 == 0, more).otherwise(plain))
    records.select(line.alias("value")).write.text(folder)
    stream = bronze.bronze_watchlist(files.watchlist_stream(spark, folder))
    return _stream_result(spark, "watchlist_rescued", stream, run=run, drop=("source_file",))


@query("silver_watchlist")
def silver_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-cased codes, ``effective_from`` parsed to a timestamp."""
    run = new_run(spark, "silver_watchlist")
    stream = _silver_watchlist_stream(spark, _stage_watchlist(spark, sf_dir, run))
    return _stream_result(spark, "silver_watchlist", stream, run=run, drop=("source_file",))


# -- gold: stream-stream join ----------------------------------------------------------------

@query("stream_stream_join")
def stream_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction stream matched with the watchlist stream by card number."""
    run = new_run(spark, "stream_stream_join")
    wl = _silver_watchlist_stream(spark, _stage_watchlist(spark, sf_dir, run))
    tx = testdata.transactions(_events_stream(spark, sf_dir))
    matches = gold.watchlist_matches(tx, wl).select(
        "transaction_id", "card_number", "transaction_timestamp", "watchlist_id",
        "effective_from")
    return _stream_result(spark, "stream_stream_join", matches, run=run)


@query("fraud_transactions")
def fraud_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist matches of known customers, as fraud alerts."""
    run = new_run(spark, "fraud_transactions")
    wl = _silver_watchlist_stream(spark, _stage_watchlist(spark, sf_dir, run))
    tx = testdata.transactions(_events_stream(spark, sf_dir))
    alerts = gold.fraud_transactions(tx, wl, _customers(spark, sf_dir))
    return _stream_result(spark, "fraud_transactions", alerts, run=run)


@query("alert_id")
def alert_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud alert ids and customer names (batch)."""
    return _batch_fraud(spark, sf_dir).select("transaction_id", "watchlist_id", "alert_id",
                                              "customer_name")


# -- alerts --------------------------------------------------------------------------------

def _batch_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-value alerts computed on batch frames."""
    tx = testdata.transactions(_events(spark, sf_dir))
    return gold.high_value_transactions(tx, _customers(spark, sf_dir))


def _batch_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud alerts computed on batch frames."""
    events = _events(spark, sf_dir)
    wl = silver.silver_watchlist(testdata.watchlist_records(events))
    return gold.fraud_transactions(testdata.transactions(events), wl, _customers(spark, sf_dir))


@query("alert_message_high_value")
def alert_message_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rendered message per high-value alert (alert time: the transaction's)."""
    return alerts.high_value_messages(_batch_high_value(spark, sf_dir).withColumn(
        "alert_timestamp", F.col("transaction_timestamp")))


@query("alert_digest")
def alert_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud alerts as one digest per customer."""
    return alerts.fraud_digests(_batch_fraud(spark, sf_dir))


@query("alert_digest_lines")
def alert_digest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table line of every fraud alert, with its digest's recipient."""
    return alerts.fraud_digest_lines(_batch_fraud(spark, sf_dir))


def _pipeline_run(spark: SparkSession, sf_dir: str, name: str) -> pipeline.Layout:
    """The whole medallion pipeline once over the test tables."""
    run = new_run(spark, name)
    layout = pipeline.Layout(run.table("pipeline"), partitions=_cores(spark), rocksdb=not is_local(spark))
    customers = testdata.customers(testdata.read_table(spark, sf_dir, "customer"),
                                   testdata.read_table(spark, sf_dir, "nation"))
    progress = pipeline.run_once(spark, layout,
                                 envelope=testdata.kafka_envelope(_events_stream(spark, sf_dir)),
                                 watchlist_folder=_stage_watchlist(spark, sf_dir, run),
                                 customers=customers)
    PROGRESS[name] = [p for step in progress.values() for p in step]
    return layout


@query("alert_outbox")
def alert_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbox after a full pipeline run: both flows, without batch ids and alert times."""
    layout = _pipeline_run(spark, sf_dir, "alert_outbox")
    timeless = F.regexp_replace("body", "<br>Alert Time: [^<]*", "")
    return spark.read.parquet(layout.outbox).drop("batch_id").withColumn("body", timeless)


@query("alert_outbox_lines")
def alert_outbox_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest lines after a full pipeline run, batch id left out."""
    layout = _pipeline_run(spark, sf_dir, "alert_outbox_lines")
    return spark.read.parquet(layout.outbox_lines).drop("batch_id")


@query("outbox_batch_summary")
def outbox_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and alerts per flow and batch after a pipeline run."""
    layout = _pipeline_run(spark, sf_dir, "outbox_batch_summary")
    return alerts.outbox_summary(spark.read.parquet(layout.outbox)).drop("batch_id")


# -- ledgers: tables with committed batches -------------------------------------------------

def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("transaction_timestamp"))


def _run_batches(spark: SparkSession, name: str, run: RunFolder, stream: DataFrame, handler) -> None:
    """Hand a stream's micro-batches to a handler until its input is done."""
    PROGRESS[name] = finish(start_foreach_batch(stream, handler, run.checkpoint(name),
                                                partitions=_cores(spark)), spark)


def _staged_events(spark: SparkSession, sf_dir: str, run: RunFolder, files_count: int = 6) -> DataFrame:
    """``events`` dealt to files that a stream takes one at a time, as transactions.

    The files have small row groups, so that many tasks read one file.
    """
    folder = run.staging("events")
    events = _events(spark, sf_dir)
    (events.repartitionByRange(files_count, "ts").write.option("parquet.block.size", STAGED_ROW_GROUP)
     .parquet(folder))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return testdata.transactions(stream)


@query("compacted_transactions")
def compacted_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions in event-date partitions after several batches, a crashed one and a compaction."""
    run = new_run(spark, "compacted_transactions")
    tx = _dated(_staged_events(spark, sf_dir, run))
    table = Ledger(spark, run.table("transactions"), tx.schema, ("event_date",)).create()
    _run_batches(spark, "compacted_transactions", run, tx, table.sink("transactions"))
    # A writer that died between its rows and its commit.
    table._write(_dated(testdata.transactions(_events(spark, sf_dir))), "a0", "never-committed")
    table.compact()
    return wall_clock(table.read().drop("event_date"))


@query("watchlist_delta_matches")
def watchlist_delta_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist matches of three deliveries of either side, without join state.

    Transactions arrive oldest first, entries newest first; one delivery is
    replayed.
    """
    run = new_run(spark, "watchlist_delta_matches")
    events = _events(spark, sf_dir)
    tx = testdata.transactions(events)
    entries = silver.silver_watchlist(testdata.watchlist_records(events))
    third = [F.lit(d).cast("timestamp") for d in ("2024-01-11", "2024-01-21")]

    def delivery_of(df: DataFrame, at: str, number: int) -> DataFrame:
        return df.filter([F.col(at) < third[0], (F.col(at) >= third[0]) & (F.col(at) < third[1]),
                          (F.col(at) >= third[1]) | F.col(at).isNull()][number])

    transactions = delta.transaction_ledger(spark, run.table("transactions"), tx.schema)
    watchlist = Ledger(spark, run.table("watchlist"), entries.schema).create()
    columns = ["transaction_id", "card_number", "transaction_timestamp", "watchlist_id", "effective_from"]
    shape = tx.join(gold.watchlist_side(entries), F.lit(True)).select(*columns).schema
    matches = Ledger(spark, run.table("matches"), shape).create()

    def step() -> None:
        delta.match_step(transactions, watchlist, matches, buckets=CARD_BUCKETS, finish=lambda m: m.select(*columns))

    for number in range(3):
        transactions.append(delta.placed(delivery_of(tx, "transaction_timestamp", number), CARD_BUCKETS),
                            "transactions", number)
        watchlist.append(delivery_of(entries, "effective_from", 2 - number), "entries", number)
        step()
    transactions.append(delta.placed(delivery_of(tx, "transaction_timestamp", 0), CARD_BUCKETS), "transactions", 0)
    step()
    return wall_clock(matches.read())


def _customer_loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """A load of all customers, one with moved and repeated ones, the first again, a late correction."""
    first = testdata.customers(testdata.read_table(spark, sf_dir, "customer"),
                               testdata.read_table(spark, sf_dir, "nation"))
    number = F.col("customer_id").cast("long")
    moved = (first.filter(number % 3 == 0).withColumn("city", F.lit("Moved"))
             .withColumn("update_timestamp", F.col("update_timestamp") + F.expr("INTERVAL 1 DAY")))
    second = moved.unionByName(first.filter(number % 3 == 1))
    # As old as the first load: it changes whom the second load left as they were.
    corrected = first.filter(number % 7 == 0).withColumn("customer_segment", F.lit("CORRECTED"))
    return [first, second, first, corrected]


def _current_customers(spark: SparkSession, sf_dir: str, root: str, loads: int) -> Ledger:
    table = current.current_table(spark, root, CUSTOMER)
    for number, load in enumerate(_customer_loads(spark, sf_dir)[:loads]):
        current.merge_load(table, load, "customer_id", "update_timestamp", number, buckets=CUSTOMER_BUCKETS)
    return table


@query("customers_current")
def customers_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current row of every customer after four loads with changed and repeated rows."""
    run = new_run(spark, "customers_current")
    return wall_clock(_current_customers(spark, sf_dir, run.table("customers"), 4).read().drop(current.BUCKET))


@query("high_value_pruned_join")
def high_value_pruned_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-value alerts of a stream whose micro-batches fetch only their own customers."""
    run = new_run(spark, "high_value_pruned_join")
    table = _current_customers(spark, sf_dir, run.table("customers"), 1)
    tx = _staged_events(spark, sf_dir, run, 3)
    alerts_of = pipeline.pruned_high_value(table, CUSTOMER_BUCKETS)
    out = Ledger(spark, run.table("alerts"), pipeline.table_schema(spark, "gold", "high_value_transactions")).create()
    _run_batches(spark, "high_value_pruned_join", run, tx, out.sink("silver.transactions", alerts_of))
    return wall_clock(out.read().drop(*PROCESSING_TIME))


@query("expectations_committed")
def expectations_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expectation counts that were committed with each micro-batch's rows, added up."""
    run = new_run(spark, "expectations_committed")
    folder = run.staging("events")
    events = _events(spark, sf_dir)
    events.repartitionByRange(4, "ts").write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    dirty = testdata.dirty_transactions(stream)
    table = Ledger(spark, run.table("transactions"), dirty.schema).create()
    _run_batches(spark, "expectations_committed", run, dirty,
                 observed_expectations(table, silver.TRANSACTION_EXPECTATIONS, "transactions"))
    totals = table.metrics().groupBy("metric").agg(F.sum("value").alias("value"))
    rows = totals.filter(F.col("metric") == "rows").select(F.col("value").alias("total_rows"))
    actions = spark.createDataFrame([(e.name, e.action) for e in silver.TRANSACTION_EXPECTATIONS],
                                    "expectation string, action string")
    return (totals.withColumnRenamed("metric", "expectation").join(F.broadcast(actions), "expectation")
            .withColumn("total_rows", rows.scalar())
            .select("expectation", "action", F.col("value").alias("failed_rows"), "total_rows"))


@query("late_rows")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction that came too late for its minute's count.

    As in ``late_rows_dropped``, the newer half of the data comes first; here
    the rows that are behind the watermark then are listed.
    """
    run = new_run(spark, "late_rows")
    folder = run.staging("events")
    events = _events(spark, sf_dir)
    cutoff = F.lit(DELIVERED_BEFORE).cast("timestamp_ntz")
    shape = testdata.transactions(events).schema
    on_time = Ledger(spark, run.table("on_time"), shape).create()
    late = Ledger(spark, run.table("late"), shape).create()
    gate = late_gate(on_time, late, "transactions")
    for part in (events.filter(F.col("ts") >= cutoff), events.filter(F.col("ts") < cutoff)):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        _run_batches(spark, "late_rows", run, testdata.transactions(stream), gate)
    return wall_clock(late.read())


@query("watchlist_evolved")
def watchlist_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist with the columns that its undeclared fields were promoted to, over two deliveries.

    The older half of the records comes with a region and a whole-numbered
    score; the newer half with scores that are halves now and then, a flag,
    and every fifth line cut off.
    """
    run = new_run(spark, "watchlist_evolved")
    folder = run.staging("watchlist_drop")
    table = EvolvingTable(spark, run.table("watchlist"), WATCHLIST_RECORD)
    events = _events(spark, sf_dir)
    cutoff = F.lit(DELIVERED_BEFORE).cast("timestamp_ntz")
    number = F.substring("watchlist_id", 3, 20).cast("long")
    region = F.when(number % 3 == 0, "eu").alias("region")
    extras = ([region, number.alias("score")],
              [region, F.when(number % 2 == 0, number.cast("string"))
               .otherwise(F.concat(number.cast("string"), F.lit(".5"))).alias("score"),
               (number % 4 == 0).alias("checked")])
    for half, more in zip((F.col("ts") < cutoff, F.col("ts") >= cutoff), extras):
        records = testdata.watchlist_records(events.filter(half))
        line = F.to_json(F.struct(*records.columns, *more))
        if len(more) == 3:
            line = F.when(number % 5 == 0, F.substring(line, 1, 30)).otherwise(line)
        records.select(line.alias("value")).write.mode("append").text(folder)
        table.promote()
        _run_batches(spark, "watchlist_evolved", run, files.watchlist_stream(spark, folder), table.sink("watchlist"))
    table.promote()
    return table.read()


def _indexed_outbox(spark: SparkSession, sf_dir: str, run: RunFolder) -> Ledger:
    """Both flows' messages of the whole data, delivered and then replayed."""
    outbox = delivery.outbox_ledger(spark, run.table("outbox"))
    flows = {alerts.HIGH_VALUE_FLOW: (_batch_high_value, alerts.high_value_messages, None),
             alerts.FRAUD_FLOW: (_batch_fraud, alerts.fraud_digests, alerts.fraud_digest_lines)}
    for flow, (alerts_of, render, render_lines) in flows.items():
        sink = delivery.indexed_sink(outbox, flow, render, render_lines)
        for _ in range(2):
            sink(alerts_of(spark, sf_dir), 0)
    return outbox


@query("alert_outbox_indexed")
def alert_outbox_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of both flows from the outbox with a committed batch index, without batch ids and alert times."""
    outbox = _indexed_outbox(spark, sf_dir, new_run(spark, "alert_outbox_indexed"))
    timeless = F.regexp_replace("body", "<br>Alert Time: [^<]*", "")
    return delivery.messages(outbox).drop("batch_id").withColumn("body", timeless)


@query("delivery_tally")
def delivery_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered, failed and pending per flow; some acknowledgements come twice, some out of order.

    The length of the recipient's address decides what the sender reports.
    """
    run = new_run(spark, "delivery_tally")
    messages = delivery.messages(_indexed_outbox(spark, sf_dir, run))
    log = delivery.acknowledgement_ledger(spark, run.table("acknowledgements"))
    known = messages.select(delivery.message_id().alias("message_id"), F.length("recipient").alias("n"),
                            F.current_timestamp().alias("acknowledged_at"))
    kinds = {delivery.DELIVERED: known.filter(F.col("n") % 3 == 0), delivery.FAILED: known.filter(F.col("n") % 3 < 2)}
    for number, status in enumerate((delivery.DELIVERED, delivery.FAILED, delivery.DELIVERED, delivery.FAILED)):
        # A message that failed first, or was reported failed later, is delivered all the same.
        log.append(kinds[status].select("message_id", F.lit(status).alias("status"), "acknowledged_at"),
                   "sender", number)
    return delivery.delivery_tally(messages, log.read()).drop("batch_id")


# -- watchlist feed ------------------------------------------------------------------------

def _stage_feed(spark: SparkSession, sf_dir: str, run) -> tuple[str, str]:
    """Feed CSV files of every watchlist record; drop folder with the first half.

    The CSV's columns are in another order than the record's and one is
    undeclared; descriptions hold quotes, commas and line breaks; every
    ninth id has no number.  It is written as lines of text, not by a CSV
    writer.
    """
    events = _events(spark, sf_dir)
    csv_path, folder = run.staging("feed_csv"), run.staging("watchlist_drop")
    records = testdata.watchlist_records(events)
    number = F.substring("watchlist_id", 3, 20).cast("long")
    values = {c: F.col(c) for c in records.columns}
    values["watchlist_id"] = F.when(number % 9 == 0, F.concat(F.lit("X"), "watchlist_id")) \
        .otherwise(F.col("watchlist_id"))
    values["reason_description"] = F.concat(F.lit('"said ""hi"", twice\nby '), "reported_by",
                                            F.lit('"'))
    order = [*reversed(records.columns), "note"]
    values["note"] = F.lit('""')
    line = F.concat_ws(",", *[values[c] for c in order])
    # A folder per part, its only file with the header first.
    header = spark.range(FEED_PARTS).select(F.col("id").alias("part"), F.lit(-1).cast("long").alias("at"),
                                            F.lit(",".join(order)).alias("value"))
    lines = records.select(F.pmod(F.xxhash64("watchlist_id"), F.lit(FEED_PARTS)).alias("part"),
                           number.alias("at"), line.alias("value"))
    (header.unionByName(lines).repartition("part").sortWithinPartitions("part", "at").drop("at")
     .write.partitionBy("part").text(csv_path))
    _deliver_older(events, folder)
    return csv_path, folder


def _deliver_older(events: DataFrame, folder: str) -> None:
    older = events.filter(F.col("ts") < F.lit(DELIVERED_BEFORE).cast("timestamp_ntz"))
    testdata.watchlist_records(older).write.json(folder)


@query("watchlist_high_water_mark")
def watchlist_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest delivered watchlist id number, and its id."""
    run = new_run(spark, "watchlist_high_water_mark")
    folder = run.staging("watchlist_drop")
    _deliver_older(_events(spark, sf_dir), folder)
    return feed.high_water_mark(feed.delivered_records(spark, folder))


@query("watchlist_new_records")
def watchlist_new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed records after the high-water mark, appended to the drop folder."""
    run = new_run(spark, "watchlist_new_records")
    csv_path, folder = _stage_feed(spark, sf_dir, run)
    return feed.deliver(spark, csv_path, folder)


@query("watchlist_rejects")
def watchlist_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed records that the high-water mark cannot place, as written to the rejects."""
    run = new_run(spark, "watchlist_rejects")
    csv_path, folder = _stage_feed(spark, sf_dir, run)
    delivered = feed.deliver(spark, csv_path, folder, run.staging("rejects"))
    return spark.read.schema(delivered.schema).json(run.staging("rejects"))
