"""The medallion pipeline as plain streaming queries over table folders.

Layout below one root (normally a folder of ``spark.checkpoint.dir`` or
another shared store)::

    bronze/transactions   bronze/fraud_watchlist   bronze/customers
    silver/transactions   silver/fraud_watchlist   silver/customers
    gold/high_value_transactions   gold/fraud_transactions
    gold/transactions_count_by_minute   gold/transactions_count_by_minute_sliding_window
    alerts/outbox   alerts/outbox_lines   quality/expectations
    _loads/customers/<fingerprint>   (customer loads already landed)
    _checkpoints/<layer>/<table>

Each step reads its input table as a stream (the customer snapshot as a
batch read) and appends to its own table with its own checkpoint, so the
steps can run on separate schedules.  ``run_once`` runs every step with an
availableNow trigger in dependency order; call it again to pick up new
input.  Nothing here schedules: the order is the order of the calls.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from ..config import CLUSTER_STREAMING
from ..operators import alerts, bronze, gold, silver
from ..operators.current import DEFAULT_BUCKETS, needed_rows
from ..operators.dedup import latest_per_key
from ..operators.joins import DEFAULT_SALT_BUCKETS
from ..schemas import (BRONZE_WATCHLIST, CUSTOMER, KAFKA_ENVELOPE, OUTBOX, OUTBOX_LINES,
                       QUALITY)
from ..sources.files import table_snapshot, table_stream, watchlist_stream
from .ledger import Ledger
from .runner import finish, start_foreach_batch, start_to_table


@dataclass(frozen=True)
class Layout:
    """Where the tables live, and how their queries are triggered.

    ``processing_time`` None runs each query over the available input and
    stops (availableNow, for scheduled runs); a value such as ``"1 minute"``
    keeps the queries running on that trigger.
    """

    root: str
    processing_time: str | None = None
    # Shuffle/state partitions of queries started on a new checkpoint;
    # None takes the session's spark.sql.shuffle.partitions.
    partitions: int | None = None
    # Files of an input table a micro-batch takes at most; None: all there are.
    max_files_per_trigger: int | None = None
    # State partitions that one card of the watchlist match is spread over.
    # Every watchlist entry is kept once per salt, so size it to the share of
    # the busiest card; it is part of the join state, fixed for a checkpoint.
    match_salts: int = DEFAULT_SALT_BUCKETS
    # Keep the state of queries on a new checkpoint in RocksDB, off the heap:
    # the watchlist match keeps every transaction.  False: as the session says.
    rocksdb: bool = False

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/_checkpoints/{layer}/{name}"

    @property
    def outbox(self) -> str:
        return self.table("alerts", "outbox")

    @property
    def outbox_lines(self) -> str:
        return self.table("alerts", "outbox_lines")


def _start(df: DataFrame, layout: Layout, layer: str, name: str) -> StreamingQuery:
    return start_to_table(df, layout.table(layer, name), layout.checkpoint(layer, name),
                          query_name=f"{layer}_{name}",
                          available_now=layout.processing_time is None,
                          processing_time=layout.processing_time,
                          partitions=layout.partitions,
                          settings=CLUSTER_STREAMING if layout.rocksdb else None)


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# Partition columns of the partitioned tables.
PARTITIONS = {("alerts", "outbox"): ["flow", "batch_id"],
              ("alerts", "outbox_lines"): ["flow", "batch_id"],
              ("quality", "expectations"): ["table", "batch_id"]}
# What each table holds (kept as the table comment in the catalog).
TABLE_COMMENTS = {
    ("bronze", "transactions"): "Card transactions as received from the message queue",
    ("bronze", "fraud_watchlist"): "Watchlist records as delivered, with the file of each",
    ("bronze", "customers"): "Customer master loads as received",
    ("silver", "transactions"): "Parsed transactions that passed the expectations",
    ("silver", "fraud_watchlist"): "Watchlist entries with normalised codes and parsed times",
    ("silver", "customers"): "Customers with a known id and a parsed open date",
    ("gold", "high_value_transactions"): "Transactions above the customer's own limit",
    ("gold", "fraud_transactions"): "Transactions on watch-listed cards of known customers",
    ("gold", "transactions_count_by_minute"): "Transactions per event-time minute",
    ("gold", "transactions_count_by_minute_sliding_window"):
        "Transactions per five-minute event-time window, one window per minute",
    ("alerts", "outbox"): "Rendered notifications, one row per message",
    ("alerts", "outbox_lines"): "Table lines of the digests, one row per alert",
    ("quality", "expectations"): "Expectation failures per table and micro-batch",
}

_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table_schema(spark: SparkSession, layer: str, name: str) -> StructType:
    """Schema of a pipeline table, from the step that writes it.

    Each step is applied to empty frames of its inputs' schemas, starting
    from the declared source schemas, so a step can start while the table
    it reads is still empty (nothing is inferred from files).  Derived once
    per process.
    """
    if (layer, name) not in _SCHEMAS:
        _SCHEMAS[(layer, name)] = _derive_schema(spark, layer, name)
    return _SCHEMAS[(layer, name)]


def _derive_schema(spark: SparkSession, layer: str, name: str) -> StructType:
    def of(lay: str, nm: str) -> DataFrame:
        return _empty(spark, table_schema(spark, lay, nm))

    if (layer, name) == ("bronze", "transactions"):
        df = bronze.bronze_transactions(_empty(spark, KAFKA_ENVELOPE))
    elif (layer, name) == ("bronze", "fraud_watchlist"):
        return BRONZE_WATCHLIST
    elif (layer, name) == ("bronze", "customers"):
        df = bronze.bronze_customers(_empty(spark, CUSTOMER))
    elif (layer, name) == ("silver", "transactions"):
        df = silver.silver_transactions(of("bronze", "transactions"))
    elif (layer, name) == ("silver", "fraud_watchlist"):
        df = silver.silver_watchlist(of("bronze", "fraud_watchlist"))
    elif (layer, name) == ("silver", "customers"):
        df = silver.silver_customers(of("bronze", "customers"))
    # A zero broadcast budget skips the size checks: the schema does not
    # depend on the join strategy, and no Spark job runs.
    elif (layer, name) == ("gold", "high_value_transactions"):
        df = gold.high_value_transactions(of("silver", "transactions"), of("silver", "customers"),
                                          broadcast_bytes=0)
    elif (layer, name) == ("gold", "fraud_transactions"):
        df = gold.fraud_transactions(of("silver", "transactions"), of("silver", "fraud_watchlist"),
                                     of("silver", "customers"), broadcast_bytes=0)
    elif (layer, name) == ("gold", "transactions_count_by_minute"):
        df = gold.transaction_counts(of("silver", "transactions"))
    elif (layer, name) == ("gold", "transactions_count_by_minute_sliding_window"):
        df = gold.sliding_transaction_counts(of("silver", "transactions"))
    elif (layer, name) == ("alerts", "outbox"):
        return OUTBOX
    elif (layer, name) == ("alerts", "outbox_lines"):
        return OUTBOX_LINES
    elif (layer, name) == ("quality", "expectations"):
        return QUALITY
    else:
        raise KeyError(f"no table {layer}.{name}")
    return df.schema


def _ensure(spark: SparkSession, layout: Layout, layer: str, name: str) -> None:
    """Make a table's folder, empty, if nothing has written it yet.

    A folder that a file sink has written is left alone, and readers of such
    a folder go by the sink's own log.
    """
    _empty(spark, table_schema(spark, layer, name)).write.mode("ignore").parquet(
        layout.table(layer, name))


def _stream(spark: SparkSession, layout: Layout, layer: str, name: str) -> DataFrame:
    _ensure(spark, layout, layer, name)
    return table_stream(spark, layout.table(layer, name), table_schema(spark, layer, name),
                        max_files_per_trigger=layout.max_files_per_trigger)


def _snapshot(spark: SparkSession, layout: Layout, layer: str, name: str) -> DataFrame:
    _ensure(spark, layout, layer, name)
    return table_snapshot(spark, layout.table(layer, name), table_schema(spark, layer, name))


def await_all(spark: SparkSession, queries: dict[str, StreamingQuery]) -> dict[str, list]:
    """Wait for queries started together; their progress reports by name."""
    return {name: finish(q, spark) for name, q in queries.items()}


def record_quality(spark: SparkSession, layout: Layout, table: str, progress: list,
                   observation: str) -> None:
    """One row per expectation and micro-batch in ``quality/expectations``.

    Written per (table, batch) with dynamic partition overwrite, so
    recording the same run twice leaves one copy.
    """
    rows = []
    for p in progress:
        metrics = p.observedMetrics.get(observation)
        if metrics is None:
            continue
        values = metrics.asDict()
        total = int(values.pop("rows"))
        rows += [(table, int(p.batchId), name, int(v), total) for name, v in values.items()]
    if rows:
        (spark.createDataFrame(rows, "table string, batch_id long, expectation string, "
                                     "failed_rows long, total_rows long")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("table", "batch_id").parquet(layout.table("quality", "expectations")))


class QualityRecorder(StreamingQueryListener):
    """Records the expectation counts of running queries, batch by batch.

    For queries started on a processing-time trigger, whose progress is
    never collected at the end of a run.  ``watch(query, table,
    observation)`` adds a query (by id, so same-named queries elsewhere are
    not affected).
    """

    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark, self.layout = spark, layout
        self.queries: dict[str, tuple[str, str]] = {}

    def watch(self, query: StreamingQuery, table: str, observation: str) -> None:
        self.queries[str(query.id)] = (table, observation)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        spec = self.queries.get(str(event.progress.id))
        if spec is not None:
            record_quality(self.spark, self.layout, spec[0], [event.progress], spec[1])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def land_transactions(spark: SparkSession, layout: Layout, envelope: DataFrame) -> StreamingQuery:
    """Kafka (or replayed) envelope stream → bronze.transactions."""
    return _start(bronze.bronze_transactions(envelope), layout, "bronze", "transactions")


def refine_transactions(spark: SparkSession, layout: Layout) -> StreamingQuery:
    """bronze.transactions → silver.transactions; counts observed per batch."""
    return _start(silver.silver_transactions(_stream(spark, layout, "bronze", "transactions"),
                                             observation="silver_transactions"),
                  layout, "silver", "transactions")


def land_watchlist(spark: SparkSession, layout: Layout, drop_folder: str) -> StreamingQuery:
    """JSON drop folder → bronze.fraud_watchlist (with the source file)."""
    stream = watchlist_stream(spark, drop_folder,
                              max_files_per_trigger=layout.max_files_per_trigger)
    return _start(bronze.bronze_watchlist(stream), layout, "bronze", "fraud_watchlist")


def refine_watchlist(spark: SparkSession, layout: Layout) -> StreamingQuery:
    """bronze.fraud_watchlist → silver.fraud_watchlist."""
    return _start(silver.silver_watchlist(_stream(spark, layout, "bronze", "fraud_watchlist")),
                  layout, "silver", "fraud_watchlist")


def land_customers(spark: SparkSession, layout: Layout, customers: DataFrame) -> None:
    """Append a load of the customer master to bronze.customers (batch), once.

    A load is known by a fingerprint of its rows; landing the same rows
    again does nothing.  The fingerprint is noted after the append, so a
    crash in between can land a load twice: ``latest_customers`` (on by
    default) keeps that, too, from doubling alerts.
    """
    rows = F.xxhash64(*customers.columns).cast("decimal(38,0)")
    total = customers.agg(F.count(F.lit(1)).alias("n"), F.sum(rows).alias("h")).first()
    note = f"{layout.root}/_loads/customers/{total['n']}_{total['h'] or 0}"
    try:
        if not spark.read.schema("landed timestamp").parquet(note).isEmpty():
            return
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":      # else: no such load yet
            raise
    bronze.bronze_customers(customers).write.mode("append").parquet(
        layout.table("bronze", "customers"))
    spark.range(1).select(F.current_timestamp().alias("landed")).write.mode("overwrite").parquet(note)


def refine_customers(spark: SparkSession, layout: Layout) -> StreamingQuery:
    """bronze.customers (as a stream) → silver.customers."""
    return _start(silver.silver_customers(_stream(spark, layout, "bronze", "customers"),
                                          observation="silver_customers"),
                  layout, "silver", "customers")


def customer_snapshot(spark: SparkSession, layout: Layout, *, latest_only: bool = True
                      ) -> DataFrame:
    """silver.customers as it is now: the latest row per id, or all rows."""
    snapshot = _snapshot(spark, layout, "silver", "customers")
    return latest_per_key(snapshot, "customer_id", "update_timestamp") if latest_only else snapshot


def build_gold(spark: SparkSession, layout: Layout, *, latest_customers: bool = True,
               max_match_age: str | None = None, watchlist_snapshot: bool = False,
               hot_customers: DataFrame | None = None, hot_cards: DataFrame | None = None
               ) -> dict[str, StreamingQuery]:
    """Start the four gold queries.  Static snapshots are read at start.

    ``latest_customers`` false joins every row of a customer id, so a
    customer landed twice doubles their alerts.  ``watchlist_snapshot``
    matches against silver.fraud_watchlist as a snapshot (no join state)
    instead of as a stream; see ``gold.watchlist_matches_snapshot`` for
    what that changes.

    No query reads history.  The match spreads every card over
    ``layout.match_salts`` state partitions; a customer table too large to
    broadcast is joined on salted keys.  An operator who knows the busy ids
    can pass them (``joins.hot_keys`` of a table) to salt only those;
    ``hot_cards`` has to stay the same for the life of the checkpoint.
    """
    if hot_cards is not None and hot_cards.isEmpty():
        raise ValueError("an empty list of busy cards would leave every card unsplit for good")
    customers = customer_snapshot(spark, layout, latest_only=latest_customers)

    def tx() -> DataFrame:
        return _stream(spark, layout, "silver", "transactions")

    watchlist = (_snapshot(spark, layout, "silver", "fraud_watchlist")
                 if watchlist_snapshot else _stream(spark, layout, "silver", "fraud_watchlist"))
    return {
        "high_value_transactions": _start(
            gold.high_value_transactions(tx(), customers, hot_customers=hot_customers),
            layout, "gold", "high_value_transactions"),
        "fraud_transactions": _start(gold.fraud_transactions(
            tx(), watchlist, customers, max_match_age=max_match_age,
            watchlist_snapshot=watchlist_snapshot, salt_buckets=layout.match_salts,
            hot_customers=hot_customers, hot_cards=hot_cards),
            layout, "gold", "fraud_transactions"),
        "transactions_count_by_minute": _start(gold.transaction_counts(tx()), layout, "gold",
                                               "transactions_count_by_minute"),
        "transactions_count_by_minute_sliding_window": _start(
            gold.sliding_transaction_counts(tx()), layout, "gold",
            "transactions_count_by_minute_sliding_window"),
    }


def pruned_high_value(customers: Ledger, buckets: int = DEFAULT_BUCKETS):
    """High-value alerts of a batch frame joined with the current rows of its own customers only.

    For customer tables too large to broadcast: the batch's keys choose the
    buckets to scan (``current.needed_rows``), and what they select is small
    enough to broadcast, or is joined with hot keys salted.
    """
    columns = ["customer_id", "email", "first_name", "last_name", "transaction_limit"]

    def alerts_of(batch: DataFrame) -> DataFrame:
        known = needed_rows(customers.on(batch.sparkSession), batch, "customer_id", "customer_id", columns,
                            buckets=buckets)
        return gold.high_value_transactions(batch, known)
    return alerts_of


def route_alerts(spark: SparkSession, layout: Layout) -> dict[str, StreamingQuery]:
    """Start both alert flows into the one outbox table, one query each."""
    flows = {
        alerts.HIGH_VALUE_FLOW: ("high_value_transactions", alerts.outbox_sink(
            layout.outbox, alerts.HIGH_VALUE_FLOW, alerts.high_value_messages)),
        alerts.FRAUD_FLOW: ("fraud_transactions", alerts.outbox_sink(
            layout.outbox, alerts.FRAUD_FLOW, alerts.fraud_digests,
            layout.outbox_lines, alerts.fraud_digest_lines)),
    }
    return {
        flow: start_foreach_batch(_stream(spark, layout, "gold", table), sink,
                                  layout.checkpoint("alerts", flow), query_name=f"alerts_{flow}",
                                  processing_time=layout.processing_time,
                                  partitions=layout.partitions)
        for flow, (table, sink) in flows.items()
    }


def run_once(spark: SparkSession, layout: Layout, *, envelope: DataFrame, watchlist_folder: str,
             customers: DataFrame | None = None, **gold_options) -> dict[str, list]:
    """Every step once, availableNow, layer by layer.

    Steps of one layer do not depend on each other and run side by side;
    a layer starts when the one it reads has finished.
    """
    if customers is not None:
        land_customers(spark, layout, customers)
    progress = await_all(spark, {
        "bronze.transactions": land_transactions(spark, layout, envelope),
        "bronze.fraud_watchlist": land_watchlist(spark, layout, watchlist_folder),
        "silver.customers": refine_customers(spark, layout),
    })
    progress.update(await_all(spark, {
        "silver.transactions": refine_transactions(spark, layout),
        "silver.fraud_watchlist": refine_watchlist(spark, layout),
    }))
    record_quality(spark, layout, "silver.customers", progress["silver.customers"],
                   "silver_customers")
    record_quality(spark, layout, "silver.transactions", progress["silver.transactions"],
                   "silver_transactions")
    progress.update(await_all(spark, {f"gold.{k}": q
                               for k, q in build_gold(spark, layout, **gold_options).items()}))
    progress.update(await_all(spark, {f"alerts.{k}": q for k, q in route_alerts(spark, layout).items()}))
    return progress


def start_all(spark: SparkSession, layout: Layout, *, envelope: DataFrame,
              watchlist_folder: str, **gold_options) -> dict[str, StreamingQuery]:
    """Start every step at once on ``layout.processing_time`` (continuous).

    Each step reads its upstream table as it grows.  The customer snapshot
    is read when the gold queries start, so customers are refined first
    (availableNow); restart the gold queries to pick up customer changes,
    or prefer scheduled ``run_once`` calls, which re-read it every run.
    """
    if layout.processing_time is None:
        raise ValueError("start_all needs layout.processing_time; use run_once for availableNow")
    first = finish(refine_customers(spark, replace(layout, processing_time=None)), spark)
    record_quality(spark, layout, "silver.customers", first, "silver_customers")
    recorder = QualityRecorder(spark, layout)
    spark.streams.addListener(recorder)
    queries = {
        "bronze.transactions": land_transactions(spark, layout, envelope),
        "bronze.fraud_watchlist": land_watchlist(spark, layout, watchlist_folder),
    }
    # watched as soon as started: a progress report follows a whole micro-batch
    queries["silver.customers"] = refine_customers(spark, layout)
    recorder.watch(queries["silver.customers"], "silver.customers", "silver_customers")
    queries["silver.transactions"] = refine_transactions(spark, layout)
    recorder.watch(queries["silver.transactions"], "silver.transactions", "silver_transactions")
    queries["silver.fraud_watchlist"] = refine_watchlist(spark, layout)
    queries.update({f"gold.{k}": q for k, q in build_gold(spark, layout, **gold_options).items()})
    queries.update({f"alerts.{k}": q for k, q in route_alerts(spark, layout).items()})
    return queries


def register_tables(spark: SparkSession, layout: Layout, prefix: str = "") -> list[str]:
    """Name every table in the session catalog: database = layer.

    Tables are external (their folders are the layout's), so dropping or
    re-registering one never touches data; each carries its comment.  After
    this, ``spark.table("silver.transactions")`` and
    ``spark.readStream.table("spark_catalog.silver.transactions")`` work.
    ``prefix`` is put before every database name.
    """
    names = []
    for (layer, name), comment in TABLE_COMMENTS.items():
        database, table = f"{prefix}{layer}", f"{prefix}{layer}.{name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` "
                  f"LOCATION '{layout.root}/{layer}'")
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        schema = table_schema(spark, layer, name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = PARTITIONS.get((layer, name))
        partitioned = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
        escaped = comment.replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet {partitioned} "
                  f"LOCATION '{layout.table(layer, name)}' COMMENT '{escaped}'")
        if parts:
            spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")
        names.append(table)
    return names


def quality_totals(spark: SparkSession, layout: Layout) -> DataFrame:
    """Failed and input rows per table and expectation over all batches."""
    return (spark.read.parquet(layout.table("quality", "expectations"))
            .groupBy("table", "expectation")
            .agg(F.sum("failed_rows").alias("failed_rows"), F.sum("total_rows").alias("total_rows")))

