"""Physical plans: pruning, pushdown, join strategy, one JSON parse per row."""

from cardwatch.operators import bronze, gold, silver
from cardwatch.plans.catalog import _customers
from cardwatch.sources import testdata
from tests.conftest import explain_text


def executed(df) -> str:
    return explain_text(df, "formatted")


def test_count_reads_one_column(spark, sf_dir):
    df = gold.transaction_counts(testdata.transactions(testdata.read_table(spark, sf_dir, "events")))
    plan = executed(df)
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan
    assert plan.count("HashAggregate") >= 2           # partial + final aggregation


def test_watchlist_filter_pushed_to_scan(spark, sf_dir):
    wl = testdata.watchlist_records(testdata.read_table(spark, sf_dir, "events"))
    text = executed(wl)
    assert "EqualTo(event_type,error)" in text and "GreaterThan(value,150.0)" in text


def test_small_customer_side_is_broadcast(spark, sf_dir):
    tx = testdata.transactions(testdata.read_table(spark, sf_dir, "events"))
    df = gold.high_value_transactions(tx, _customers(spark, sf_dir))
    assert "BroadcastHashJoin" in executed(df)


def test_large_customer_side_is_not_broadcast_whole(spark, sf_dir):
    tx = testdata.transactions(testdata.read_table(spark, sf_dir, "events"))
    df = gold.high_value_transactions(tx, _customers(spark, sf_dir), broadcast_bytes=4_000)
    plan = explain_text(df, "extended").split("== Analyzed Logical Plan ==")[1] \
        .split("== Optimized Logical Plan ==")[0]
    # one shuffle join; only busy customers are salted (the hot list is broadcast)
    assert "_salt" in plan and "Union" not in plan
    assert plan.count("ResolvedHint (strategy=broadcast)") == 2
    assert df.count() == gold.high_value_transactions(tx, _customers(spark, sf_dir)).count()


def test_json_parsed_once_per_row(spark, sf_dir):
    envelope = testdata.kafka_envelope(testdata.read_table(spark, sf_dir, "events"))
    df = silver.silver_transactions(bronze.bronze_transactions(envelope))
    plan = executed(df)
    assert plan.count("from_json(") == 1
    assert "CollectMetrics" in plan
