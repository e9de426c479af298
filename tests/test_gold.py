"""Alerts: limit comparison, join fan-out, join strategies, watchlist match."""

import math
from datetime import datetime

from pyspark.sql import functions as F

from cardwatch.operators import gold, joins
from cardwatch.operators.dedup import latest_per_key
from tests.conftest import explain_text

TX_SCHEMA = ("transaction_id string, customer_id string, card_number string, "
             "merchant_id string, merchant_name string, merchant_category string, "
             "amount double, currency string, transaction_type string, payment_channel string, "
             "device_id string, city string, country string, transaction_timestamp timestamp, "
             "is_international boolean, status string")
CUST_SCHEMA = ("customer_id string, first_name string, last_name string, email string, "
               "transaction_limit decimal(18,2), update_timestamp timestamp")
T0 = datetime(2024, 1, 1, 10, 0, 0)


def tx(spark, rows):
    full = [(tid, cid, card, "M", "m", "cat", amt, "USD", "purchase", "pos", "D", "X", "US",
             T0, False, "ok") for tid, cid, card, amt in rows]
    return spark.createDataFrame(full, TX_SCHEMA)


def customers(spark, rows):
    return spark.createDataFrame(rows, CUST_SCHEMA)


def test_limit_comparison_edges(spark):
    from decimal import Decimal
    c = customers(spark, [("C1", "Ada", None, "a@x", Decimal("100.00"), T0)])
    t = tx(spark, [("eq", "C1", "1", 100.0), ("cent", "C1", "1", 100.01), ("null", "C1", "1", None),
                   ("nan", "C1", "1", math.nan), ("low", "C1", "1", 5.0),
                   ("unknown", "C9", "1", 1e9)])
    got = {r.transaction_id: r for r in gold.high_value_transactions(t, c).collect()}
    assert set(got) == {"cent", "nan"}          # NaN is larger than any number in Spark
    assert got["cent"].alert_id == "ALERT-cent"
    assert got["cent"].customer_name == "Ada"  # NULL last name skipped


def test_duplicate_customers_fan_out_and_latest_fixes_it(spark):
    from decimal import Decimal
    c = customers(spark, [("C1", "Ada", "L", "old@x", Decimal("1.00"), datetime(2024, 1, 1)),
                          ("C1", "Ada", "L", "new@x", Decimal("1.00"), datetime(2024, 2, 1))])
    t = tx(spark, [("t1", "C1", "1", 50.0)])
    assert gold.high_value_transactions(t, c).count() == 2
    fixed = gold.high_value_transactions(t, latest_per_key(c, "customer_id", "update_timestamp"))
    assert [r.customer_email for r in fixed.collect()] == ["new@x"]


def test_salted_join_equals_broadcast_join(spark, sf_dir):
    from cardwatch.plans.catalog import _customers
    from cardwatch.sources import testdata
    t = testdata.transactions(testdata.read_table(spark, sf_dir, "events"))
    c = gold.customer_side(_customers(spark, sf_dir))
    on = [("customer_id", gold.CUSTOMER_KEY)]
    cols = ["transaction_id", "customer_email", "transaction_limit"]
    plain = t.join(c, t.customer_id == c[gold.CUSTOMER_KEY]).select(cols)
    salted = joins.salted_join(t, c, on, ["transaction_id"], 5).select(cols)
    assert sorted(plain.collect()) == sorted(salted.collect())
    plan = explain_text(salted, "formatted")
    assert "Generate" in plan and "explode" in plan


def skewed(spark):
    """10,000 facts, a third of them on one key; 1,001 dimension rows."""
    facts = spark.range(10_000).select(
        F.col("id").cast("string").alias("fid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise((F.col("id") % 1000).cast("string")).alias("k"))
    dim = spark.range(1001).select(
        F.when(F.col("id") == 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("dk"),
        F.when(F.col("id") == 1000, F.lit(-1)).otherwise(F.col("id") * 2).alias("v"))
    return facts, dim


def test_hot_key_split_equals_plain_join(spark):
    facts, dim = skewed(spark)
    hot = joins.hot_keys(facts, ["k"], 0.01, partitions=8)
    assert [(r.k, r._buckets) for r in hot.collect()] == [("hot", 3)]   # 3334 rows * 8 / 10000
    plain = facts.join(dim, facts.k == dim.dk).select("fid", "v")
    split = joins.join_dimension(facts, dim, [("k", "dk")], ["fid"], broadcast_bytes=4_000,
                                 min_hot_share=0.01)
    assert sorted(plain.collect()) == sorted(split.select("fid", "v").collect())
    logical = explain_text(split, "extended").split("== Optimized Logical Plan ==")[1]
    assert "Union" not in logical and "_salt" in logical      # one pass over the facts


def test_only_hot_keys_are_repeated(spark):
    facts, dim = skewed(spark)
    hot = joins.hot_keys(facts, ["k"], 0.01, partitions=8)
    flags = hot.select(F.col("k").alias("_hot_k"), "_buckets")
    repeated = joins.hot_key_salted_join(facts, dim, [("k", "dk")], hot, ["fid"])
    salts = repeated.groupBy("k").agg(F.countDistinct(
        joins.salt_of(["fid"], 1)).alias("n"))
    assert flags.count() == 1 and salts.count() == 1001
    # the hot key's facts are spread over 3 join keys, every other key over 1
    per_task = facts.join(F.broadcast(flags), facts.k == flags._hot_k, "left").withColumn(
        "s", F.coalesce(F.pmod(F.xxhash64("fid"), F.col("_buckets")), F.lit(0)))
    shards = per_task.filter(F.col("k") == "hot").groupBy("s").count().collect()
    assert len(shards) == 3 and max(r["count"] for r in shards) < 3334 * 0.5


def test_hot_key_split_for_streams_uses_history(spark, tmp_path):
    facts, dim = skewed(spark)
    facts.write.parquet(str(tmp_path / "facts"))
    stream = spark.readStream.schema(facts.schema).parquet(str(tmp_path / "facts"))
    hot = joins.hot_keys(spark.read.parquet(str(tmp_path / "facts")), ["k"], 0.01)
    joined = joins.join_dimension(stream, dim, [("k", "dk")], ["fid"], broadcast_bytes=4_000,
                                  hot=hot).select("fid", "v")
    from cardwatch.config import new_run
    from cardwatch.streaming.runner import run_to_table
    run = new_run(spark, "test_hot_stream")
    run_to_table(joined, run.table("j"), run.checkpoint("j"))
    got = spark.read.parquet(run.table("j"))
    assert got.count() == 10_000
    assert got.filter(F.col("v") == -1).count() == 3334


def test_size_check_measures_text(spark):
    small = spark.range(10).select(F.col("id").cast("string").alias("k"))
    each = joins.ROW_OVERHEAD + 8 + 8 + 8 + 1     # null bits, field, text in words of 8
    assert joins.fits_broadcast(small, 10 * each) and not joins.fits_broadcast(small, 10 * each - 1)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("k"))
    assert not joins.fits_broadcast(wide, 5_000)          # long text is counted as it is
    many = spark.range(100_000).select(F.col("id").alias("k"))
    assert not joins.fits_broadcast(many, 16 * 1000)    


def test_hot_key_is_spread_over_salts(spark):
    big = spark.range(9000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("i"))
    salts = big.select(joins.salt_of(["i"], 8).alias("s")).groupBy("s").count().collect()
    assert len(salts) == 8 and max(r["count"] for r in salts) < 9000 / 4


WL_SCHEMA = ("watchlist_id string, entity_id string, watch_type string, risk_level string, "
             "action string, reason_code string, reason_description string, "
             "effective_from timestamp, reported_by string, reported_source string, "
             "city string, country string")


def watchlist(spark, rows):
    return spark.createDataFrame(
        [(wid, card, "CARD", "HIGH", "BLOCK", "R", "d", when, "x", "y", "WC", "WL")
         for wid, card, when in rows], WL_SCHEMA)


def test_fraud_match_semantics(spark):
    from decimal import Decimal
    c = customers(spark, [("C1", "Ada", "L", "a@x", Decimal("1.00"), T0)])
    t = tx(spark, [("t1", "C1", "4000", 5.0), ("t2", "C1", "5000", 5.0),
                   ("t3", "C9", "4000", 5.0)])
    w = watchlist(spark, [("WL1", "4000", datetime(2024, 2, 1)),      # dated after: still matches
                          ("WL2", "4000", datetime(2023, 1, 1)),      # two entries for one card
                          ("WL3", "9999", T0)])                       # no such card
    got = sorted((r.alert_id, r.watchlist_city, r.transaction_city)
                 for r in gold.fraud_transactions(t, w, c).collect())
    assert got == [("FRAUD-t1-WL1", "WC", "X"), ("FRAUD-t1-WL2", "WC", "X")]
    bounded = gold.fraud_transactions(t, w, c, max_match_age="400 days")
    assert [r.alert_id for r in bounded.collect()] == ["FRAUD-t1-WL2"]


def test_snapshot_match_equals_stream_match_on_a_complete_watchlist(spark, sf_dir):
    from cardwatch.operators import silver
    from cardwatch.plans.catalog import _customers
    from cardwatch.sources import testdata
    events = testdata.read_table(spark, sf_dir, "events")
    t = testdata.transactions(events)
    w = silver.silver_watchlist(testdata.watchlist_records(events))
    c = _customers(spark, sf_dir)
    cols = ["alert_id", "customer_email", "watchlist_effective_from"]
    joined = gold.fraud_transactions(t, w, c).select(cols)
    snap = gold.fraud_transactions(t, w, c, watchlist_snapshot=True).select(cols)
    assert sorted(joined.collect()) == sorted(snap.collect())
    plan = explain_text(snap, "extended").split("== Optimized Logical Plan ==")[1]
    assert "_salt" not in plan          # small watchlist: broadcast, no salting


def test_customer_edge_rows(spark):
    from decimal import Decimal
    from cardwatch.operators import alerts, bronze, silver
    from cardwatch.schemas import CUSTOMER
    base = {f.name: None for f in CUSTOMER.fields}
    rows = [
        {**base, "customer_id": "C1", "first_name": "A<&>", "last_name": "B", "email": "a@x",
         "account_open_date": "2021-02-29", "transaction_limit": Decimal("10.00")},
        {**base, "customer_id": "C2", "first_name": "N", "email": "n@x",
         "account_open_date": "2021-03-01", "transaction_limit": None},
        {**base, "customer_id": None, "first_name": "X", "transaction_limit": Decimal("1.00")},
    ]
    raw = spark.createDataFrame([tuple(r[f.name] for f in CUSTOMER.fields) for r in rows], CUSTOMER)
    cust = silver.silver_customers(bronze.bronze_customers(raw))
    got = {r.customer_id: r for r in cust.collect()}
    assert set(got) == {"C1", "C2"}                          # NULL id dropped
    assert got["C1"].account_open_date is None               # not a calendar date
    assert str(got["C2"].account_open_date) == "2021-03-01"
    t = tx(spark, [("t1", "C1", "1", 50.0), ("t2", "C2", "1", 1e12)])
    hv = gold.high_value_transactions(t, cust)
    assert [r.transaction_id for r in hv.collect()] == ["t1"]   # NULL limit: no alert
    body = alerts.high_value_messages(hv).first().body
    assert "Dear A&lt;&amp;&gt; B," in body and "USD 50.00" in body and "USD 10.00" in body
