"""The medallion pipeline run twice over growing input, from its checkpoints."""

from pyspark.sql import functions as F

from cardwatch.config import new_run
from cardwatch.operators import gold, silver
from cardwatch.plans.catalog import _customers
from cardwatch.sources import kafka, testdata
from cardwatch.streaming import pipeline, runner
from tests.conftest import explain_text

CUTOFF = "2024-01-16 00:00:00"


def test_pipeline_is_incremental(spark, sf_dir):
    events = testdata.read_table(spark, sf_dir, "events")
    run = new_run(spark, "test_pipeline")
    layout = pipeline.Layout(run.table("pipeline"))
    envelope_dir, drop_dir = run.staging("envelope"), run.staging("watchlist_drop")
    customers = testdata.customers(testdata.read_table(spark, sf_dir, "customer"),
                                   testdata.read_table(spark, sf_dir, "nation"))

    def deliver(part, watchlist=True):
        testdata.kafka_envelope(part).write.mode("append").parquet(envelope_dir)
        records = testdata.watchlist_records(part)
        (records if watchlist else records.limit(0)).write.mode("append").json(drop_dir)

    # first run: no watchlist entry has arrived yet (empty drop folder)
    deliver(events.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz")), watchlist=False)
    first = pipeline.run_once(spark, layout, envelope=kafka.replay_envelope(
        spark, envelope_dir, partitions=4), watchlist_folder=drop_dir, customers=customers)
    outbox_1 = spark.read.parquet(layout.outbox).count()
    assert spark.read.parquet(layout.table("gold", "fraud_transactions")).count() == 0

    # second run: the rest of the transactions and every watchlist entry; entries
    # match transactions of the first run, kept in the join state
    deliver(events.filter(F.col("ts") >= F.lit(CUTOFF).cast("timestamp_ntz")))
    testdata.watchlist_records(events.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))) \
        .write.mode("append").json(drop_dir)
    pipeline.run_once(spark, layout, envelope=kafka.replay_envelope(
        spark, envelope_dir, partitions=4), watchlist_folder=drop_dir)

    # every transaction landed once, across the two runs
    assert spark.read.parquet(layout.table("silver", "transactions")).count() == events.count()
    # the match kept its state across the restart: same alerts as one batch join
    tx = testdata.transactions(events)
    wl = silver.silver_watchlist(testdata.watchlist_records(events))
    want = gold.fraud_transactions(tx, wl, _customers(spark, sf_dir)).select("alert_id")
    got = spark.read.parquet(layout.table("gold", "fraud_transactions")).select("alert_id")
    assert sorted(got.collect()) == sorted(want.collect())
    # the outbox only grew; fraud digests count every alert exactly once
    outbox = spark.read.parquet(layout.outbox)
    assert outbox.count() > outbox_1 > 0
    fraud_listed = outbox.filter(F.col("flow") == "fraud").agg(F.sum("alert_count")).first()[0]
    assert fraud_listed == want.count()
    assert spark.read.parquet(layout.outbox_lines).count() == want.count()
    # closed windows are final: none emitted twice
    counts = spark.read.parquet(layout.table("gold", "transactions_count_by_minute"))
    assert counts.count() == counts.select("window_start").distinct().count()
    # expectation counts recorded per batch and table
    totals = {(r.table, r.expectation): r.total_rows
              for r in pipeline.quality_totals(spark, layout).collect()}
    assert totals[("silver.transactions", "valid_amount")] == events.count()
    assert totals[("silver.customers", "valid_customer_id")] == customers.count()
    assert first["silver.transactions"][0].numInputRows > 0


def test_pipeline_runs_continuously(spark, sf_dir):
    """All steps started at once on a processing-time trigger."""
    events = testdata.read_table(spark, sf_dir, "events")
    run = new_run(spark, "test_continuous")
    layout = pipeline.Layout(run.table("pipeline"), processing_time="1 second")
    envelope_dir, drop_dir = run.staging("envelope"), run.staging("watchlist_drop")
    testdata.kafka_envelope(events).write.parquet(envelope_dir)
    testdata.watchlist_records(events).write.json(drop_dir)
    pipeline.land_customers(spark, layout, testdata.customers(
        testdata.read_table(spark, sf_dir, "customer"), testdata.read_table(spark, sf_dir, "nation")))
    queries = pipeline.start_all(spark, layout, envelope=kafka.replay_envelope(spark, envelope_dir),
                                 watchlist_folder=drop_dir)
    try:
        for q in queries.values():          # in dependency order
            q.processAllAvailable()
    finally:
        for q in queries.values():
            q.stop()
    tx = testdata.transactions(events)
    c = _customers(spark, sf_dir)
    hv = spark.read.parquet(layout.table("gold", "high_value_transactions"))
    assert hv.count() == gold.high_value_transactions(tx, c).count() > 0
    outbox = spark.read.parquet(layout.outbox)
    assert outbox.filter(F.col("flow") == "high_value").count() == hv.count()
    # expectation counts were recorded while the queries ran (listener)
    import time
    for _ in range(30):
        totals = {(r.table, r.expectation): r.total_rows
                  for r in pipeline.quality_totals(spark, layout).collect()}
        if totals.get(("silver.transactions", "valid_amount")) == events.count():
            break
        time.sleep(1)
    assert totals[("silver.transactions", "valid_amount")] == events.count()


def test_tables_are_registered_by_name(spark, sf_dir):
    from cardwatch.plans.catalog import _pipeline_run
    layout = _pipeline_run(spark, sf_dir, "test_register")
    names = pipeline.register_tables(spark, layout, prefix="reg_")
    assert "reg_silver.transactions" in names and len(names) == len(pipeline.TABLE_COMMENTS)
    assert spark.table("reg_silver.transactions").count() == \
        spark.read.parquet(layout.table("silver", "transactions")).count()
    comment = spark.sql("DESCRIBE TABLE EXTENDED reg_gold.fraud_transactions") \
        .filter("col_name = 'Comment'").first().data_type
    assert comment == pipeline.TABLE_COMMENTS[("gold", "fraud_transactions")]
    assert spark.readStream.table("spark_catalog.reg_gold.high_value_transactions").isStreaming
    flows = {r.flow for r in spark.table("reg_alerts.outbox").select("flow").distinct().collect()}
    assert flows == {"high_value", "fraud"}


def _inputs(spark, sf_dir, run):
    events = testdata.read_table(spark, sf_dir, "events")
    envelope_dir, drop_dir = run.staging("envelope"), run.staging("watchlist_drop")
    testdata.kafka_envelope(events).write.parquet(envelope_dir)
    testdata.watchlist_records(events).write.json(drop_dir)
    customers = testdata.customers(testdata.read_table(spark, sf_dir, "customer"),
                                   testdata.read_table(spark, sf_dir, "nation"))
    return events, kafka.replay_envelope(spark, envelope_dir), drop_dir, customers


def test_loads_are_idempotent_and_may_come_late(spark, sf_dir):
    """A run without customers works; landing the same master again doubles no alert."""
    run = new_run(spark, "test_loads")
    layout = pipeline.Layout(run.table("pipeline"))
    events, envelope, drop_dir, customers = _inputs(spark, sf_dir, run)
    none = envelope.filter(F.lit(False))
    pipeline.run_once(spark, pipeline.Layout(run.table("no_customers")), envelope=none,
                      watchlist_folder=drop_dir)
    pipeline.run_once(spark, layout, envelope=envelope, watchlist_folder=drop_dir,
                      customers=customers)
    pipeline.run_once(spark, layout, envelope=envelope, watchlist_folder=drop_dir,
                      customers=customers)
    got = spark.read.parquet(layout.table("gold", "high_value_transactions"))
    want = gold.high_value_transactions(testdata.transactions(events), _customers(spark, sf_dir))
    assert got.count() == want.count() > 0
    assert spark.read.parquet(layout.table("bronze", "customers")).count() == customers.count()
    changed = customers.withColumn("update_timestamp", F.col("update_timestamp") + F.expr("interval 1 day"))
    pipeline.land_customers(spark, layout, changed)
    pipeline.await_all(spark, {"c": pipeline.refine_customers(spark, layout)})
    assert pipeline.customer_snapshot(spark, layout).count() == customers.count()
    assert pipeline.customer_snapshot(spark, layout, latest_only=False).count() == 2 * customers.count()


def test_gold_plan_reads_no_history(spark, sf_dir):
    """Without a list of busy ids, the batch plan's only transactions are the source's."""
    run = new_run(spark, "test_history")
    layout = pipeline.Layout(run.table("pipeline"))
    tx = pipeline._stream(spark, layout, "silver", "transactions")
    customers = pipeline.customer_snapshot(spark, layout)
    for joined in (gold.high_value_transactions(tx, customers),
                   gold.high_value_transactions(tx, customers, broadcast_bytes=0)):
        plan = explain_text(joined, "simple")
        assert plan.count("silver/transactions") <= 1 and plan.count("StreamingRelation") == 1


def test_many_micro_batches_are_all_counted(spark, sf_dir):
    """More batches than a query keeps reports for (100)."""
    run = new_run(spark, "test_batches")
    folder = run.staging("rows")
    spark.range(0, 125, 1, 125).write.parquet(folder)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(folder)
    progress = runner.run_to_table(stream, run.table("t"), run.checkpoint("t"))
    batches = [p for p in progress if p.numInputRows]
    assert len(batches) > 100 and sum(p.numInputRows for p in batches) == 125


def test_a_card_that_becomes_hot_after_an_empty_start_is_spread(spark, tmp_path):
    """The match starts on nothing; then one card holds a third of all rows."""
    run = new_run(spark, "test_hot_card")
    schema = "transaction_id string, card_number string, transaction_timestamp timestamp"
    tx_dir, wl_dir = run.staging("tx"), run.staging("wl")
    at = F.lit("2024-01-01 10:00:00").cast("timestamp")
    spark.createDataFrame([], schema).write.parquet(tx_dir)
    fields = ("watchlist_id string, entity_id string, watch_type string, risk_level string, "
              "action string, reason_code string, reason_description string, "
              "effective_from timestamp, reported_by string, reported_source string, "
              "city string, country string")
    spark.createDataFrame([], fields).write.parquet(wl_dir)

    def matches():
        return gold.watchlist_matches(spark.readStream.schema(schema).parquet(tx_dir),
                                      spark.readStream.schema(fields).parquet(wl_dir)).select(
            "transaction_id", "watchlist_id")
    runner.run_to_table(matches(), run.table("m"), run.checkpoint("m"), partitions=8)
    rows = spark.range(600).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("card_number"),
        at.alias("transaction_timestamp"))
    rows.write.mode("append").parquet(tx_dir)
    entry = {"watchlist_id": F.lit("W1"), "entity_id": F.lit("hot"), "effective_from": at}
    spark.range(1).select(*[(entry.get(n, F.lit("x")).cast(t)).alias(n) for n, t in (
        f.rsplit(" ", 1) for f in fields.split(", "))]).write.mode("append").parquet(wl_dir)
    runner.run_to_table(matches(), run.table("m"), run.checkpoint("m"), partitions=8)
    assert spark.read.parquet(run.table("m")).count() == 200
    state = (spark.read.format("statestore").option("joinSide", "left").load(run.checkpoint("m"))
             .filter("key.field0 = 'hot'").groupBy("partition_id").count().collect())
    assert len(state) >= 4 and max(r["count"] for r in state) <= 100
