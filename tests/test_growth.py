"""Figures of a step that must not grow with its input."""

import glob
import json
import re

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import current, joins
from cardwatch.plans import catalog
from cardwatch.streaming import ledger, pipeline, runner
from tests.conftest import explain_text


@pytest.fixture
def setting(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _files(table):
    return glob.glob(f"{table.data}/**/part-*.parquet", recursive=True)


def _table(spark, path):
    return ledger.Ledger(spark, str(path), spark.createDataFrame([], "day string, id long, text string").schema,
                         ("day",)).create()


def _rows(spark, n):
    return spark.range(n).select(F.lit("d").alias("day"), "id", F.sha2(F.col("id").cast("string"), 512).alias("text"))


def test_large_partition_is_written_by_more_tasks_adaptive(spark, tmp_path, setting):
    setting("spark.sql.adaptive.enabled", "true")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    setting("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    table = _table(spark, tmp_path / "t")
    table.append(_rows(spark, 20_000), "s", 0)
    assert len(_files(table)) > 4
    assert table.read().count() == 20_000


def test_large_partition_is_written_by_more_tasks_in_micro_batches(spark, tmp_path, setting, monkeypatch):
    setting("spark.sql.adaptive.enabled", "false")
    monkeypatch.setattr(ledger, "ROWS_PER_WRITER", 100, raising=False)
    table = _table(spark, tmp_path / "t")
    assert table.append(_rows(spark, 1000), "s", 0)
    assert len(_files(table)) > 2
    assert table.read().select("id").distinct().count() == table.read().count() == 1000


def test_staged_files_can_be_read_by_many_tasks(spark, tmp_path, sf_dir, monkeypatch):
    import pyarrow.parquet as pq
    monkeypatch.setattr(catalog, "STAGED_ROW_GROUP", 4096, raising=False)
    run = catalog.RunFolder(str(tmp_path))
    catalog._staged_events(spark, sf_dir, run, 1)
    file, = glob.glob(run.staging("events") + "/*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1


def test_pipeline_state_is_kept_in_rocksdb(spark, tmp_path, sf_dir):
    layout = pipeline.Layout(str(tmp_path / "p"), partitions=2, rocksdb=True)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    tx = catalog.testdata.transactions(catalog._events_stream(spark, sf_dir))
    runner.finish(pipeline._start(catalog.gold.transaction_counts(tx), layout, "gold", "counts"), spark)
    assert spark.conf.get(provider, None) == before
    first, = glob.glob(layout.checkpoint("gold", "counts") + "/offsets/0")
    conf = json.loads(open(first).read().splitlines()[1])["conf"]
    assert conf[provider].endswith("RocksDBStateStoreProvider")


def test_merge_keeps_the_buckets_of_all_keys(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 3)], "id string, at int")
    table = current.current_table(spark, str(tmp_path / "c"), rows.schema)
    current.merge_load(table, rows, "id", "at", 0, buckets=4)
    assert {(r["id"], r["at"]) for r in table.read().toLocalIterator()} == {("a", 2), ("b", 1)}


def _joins(query):
    """The joins of a finished query's last micro-batch, as its plan names them."""
    plan = explain_text(query, True).split("== Physical Plan ==")[1]
    return set(re.findall(r"\w+Join(?= )", plan))


def _two_sides(spark, path):
    spark.range(1000).select(F.col("id").cast("string").alias("fid"),
                             (F.col("id") % 50).cast("string").alias("k")).write.parquet(f"{path}/facts")
    spark.range(50).select(F.col("id").cast("string").alias("dk"), F.lit("x").alias("v")).write.parquet(f"{path}/dim")
    return spark.read.parquet(f"{path}/facts"), spark.read.parquet(f"{path}/dim")


@pytest.mark.parametrize("buckets", [1, 4])
def test_side_measured_too_large_is_not_broadcast_to_a_stream(spark, tmp_path, buckets):
    facts, dim = _two_sides(spark, tmp_path)          # files far below Spark's own threshold
    stream = spark.readStream.schema(facts.schema).parquet(str(tmp_path / "facts"))
    joined = joins.join_dimension(stream, dim, [("k", "dk")], ["fid"], broadcast_bytes=100, salt_buckets=buckets)
    query = runner.start_to_table(joined.select("fid", "v"), str(tmp_path / "j"), str(tmp_path / "c"), partitions=2)
    runner.finish(query, spark)
    assert _joins(query) == {"SortMergeJoin"}
    assert spark.read.parquet(str(tmp_path / "j")).distinct().count() == 1000


def test_side_too_large_is_not_broadcast_when_no_key_is_busy(spark, tmp_path, setting):
    setting("spark.sql.adaptive.enabled", "false")
    facts, dim = _two_sides(spark, tmp_path)
    hot = spark.sql("SELECT 'a' AS k WHERE false")
    joined = joins.hot_key_salted_join(facts, dim, [("k", "dk")], hot, ["fid"])
    plan = explain_text(joined, "simple")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert joined.select("fid").distinct().count() == joined.count() == 1000


def test_customers_measured_too_large_are_not_broadcast_to_the_match(spark, tmp_path, sf_dir):
    run = catalog.RunFolder(str(tmp_path))
    catalog._customers(spark, sf_dir).write.parquet(run.table("customers"))
    tx = catalog.testdata.transactions(catalog._events_stream(spark, sf_dir))
    entries = catalog._silver_watchlist_stream(spark, catalog._stage_watchlist(spark, sf_dir, run))
    found = catalog.gold.fraud_transactions(tx, entries, spark.read.parquet(run.table("customers")), broadcast_bytes=100)
    query = runner.start_to_table(found, run.table("fraud"), run.checkpoint("fraud"), partitions=2)
    runner.finish(query, spark)
    assert _joins(query) == {"StreamingSymmetricHashJoin", "SortMergeJoin"}
    assert {r[0] for r in spark.read.parquet(run.table("fraud")).select("alert_id").collect()} == {
        r[0] for r in catalog._batch_fraud(spark, sf_dir).select("alert_id").collect()}


def test_pipeline_does_not_broadcast_customers_measured_too_large(spark, sf_dir, monkeypatch):
    ran, await_all = {}, pipeline.await_all
    monkeypatch.setattr(pipeline, "await_all", lambda session, queries: ran.update(queries) or await_all(session, queries))
    monkeypatch.setattr(joins, "fits_broadcast", lambda *_: False)
    summary = catalog.outbox_batch_summary(spark, sf_dir)
    assert _joins(ran["gold.high_value_transactions"]) == {"SortMergeJoin"}
    assert _joins(ran["gold.fraud_transactions"]) == {"StreamingSymmetricHashJoin", "SortMergeJoin"}
    monkeypatch.undo()
    messages = catalog.alerts.fraud_digests(catalog._batch_fraud(spark, sf_dir)).count()
    high, fraud = catalog._batch_high_value(spark, sf_dir).count(), catalog._batch_fraud(spark, sf_dir).count()
    assert {tuple(r) for r in summary.collect()} == {("high_value", high, high), ("fraud", messages, fraud)}
