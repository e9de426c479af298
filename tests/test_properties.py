"""Properties over generated inputs (fixed seed, few examples: each runs Spark)."""

from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, seed, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.operators import alerts, gold, joins

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = datetime(2024, 1, 1)


@seed(7)
@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=6 * 3600), min_size=1, max_size=300))
def test_every_row_is_in_five_sliding_windows(spark, offsets):
    df = spark.createDataFrame([(T0 + timedelta(seconds=s),) for s in offsets],
                               "transaction_timestamp timestamp")
    counts = gold.sliding_transaction_counts(df)
    assert counts.agg(F.sum("transactions_count")).first()[0] == 5 * len(offsets)
    tumbling = gold.transaction_counts(df)
    assert tumbling.agg(F.sum("transactions_count")).first()[0] == len(offsets)


@seed(11)
@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.floats(-50, 150))),
                min_size=1, max_size=80),
       st.lists(st.integers(0, 100), min_size=6, max_size=6))
def test_every_alert_is_over_its_limit(spark, txs, limits):
    tx = spark.createDataFrame(
        [(f"T{i}", f"C{c}", amt, "USD", T0) for i, (c, amt) in enumerate(txs)],
        "transaction_id string, customer_id string, amount double, currency string, "
        "transaction_timestamp timestamp")
    for col in ["merchant_name", "merchant_category", "transaction_type", "payment_channel",
                "city", "country", "status"]:
        tx = tx.withColumn(col, F.lit("x"))
    tx = tx.withColumn("is_international", F.lit(False))
    customers = spark.createDataFrame(
        [(f"C{c}", "F", "L", "e@x", Decimal(lim)) for c, lim in enumerate(limits)],
        "customer_id string, first_name string, last_name string, email string, "
        "transaction_limit decimal(18,2)")
    got = gold.high_value_transactions(tx, customers).collect()
    want = sum(1 for c, amt in txs if amt is not None and amt > limits[c])
    assert len(got) == want
    assert all(r.transaction_amount > float(r.transaction_limit) for r in got)


@seed(13)
@SETTINGS
@given(st.dictionaries(st.sampled_from(list("abcdefgh")), st.integers(1, 400), min_size=1))
def test_digests_count_every_alert_once(spark, per_customer):
    rows = [(f"A-{c}-{i:04d}", "FRAUD_WATCHLIST_MATCH", f"{c}@x", c, f"T{i}", 1.0, "USD", "m",
             "t", "x", "y", T0, "HIGH", "BLOCK", "r")
            for c, n in per_customer.items() for i in range(n)]
    df = spark.createDataFrame(rows, "alert_id string, alert_type string, customer_email string, "
                               "customer_name string, transaction_id string, amount double, "
                               "currency string, merchant_name string, transaction_type string, "
                               "transaction_city string, transaction_country string, "
                               "transaction_timestamp timestamp, risk_level string, "
                               "action string, reason_description string")
    digests = alerts.fraud_digests(df).collect()
    assert {d.recipient_name: d.alert_count for d in digests} == per_customer
    lines = alerts.fraud_digest_lines(df).groupBy("recipient_name").count().collect()
    assert {x[0]: x[1] for x in lines} == per_customer


@seed(17)
@SETTINGS
@given(st.lists(st.sampled_from(["hot"] * 6 + [str(i) for i in range(40)]), min_size=1,
                max_size=400),
       st.integers(0, 1_000))
def test_dimension_join_equals_plain_join_under_skew(spark, keys, budget):
    facts = spark.createDataFrame([(str(i), k) for i, k in enumerate(keys)], "fid string, k string")
    dim = spark.createDataFrame([(k, len(k)) for k in ["hot"] + [str(i) for i in range(30)]],
                                "dk string, v long")
    plain = sorted(facts.join(dim, facts.k == dim.dk).select("fid", "v").collect())
    split = joins.join_dimension(facts, dim, [("k", "dk")], ["fid"], broadcast_bytes=budget,
                                 min_hot_share=0.05).select("fid", "v")
    assert sorted(split.collect()) == plain
