"""Digests, message escaping, the watchlist feed."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardwatch.config import new_run
from cardwatch.operators import alerts, feed
from cardwatch.schemas import WATCHLIST_RECORD
from cardwatch.sources.files import read_watchlist_csv
from tests.conftest import explain_text

ALERT_SCHEMA = ("alert_id string, alert_type string, customer_email string, customer_name string, "
                "transaction_id string, amount double, currency string, merchant_name string, "
                "transaction_type string, transaction_city string, transaction_country string, "
                "transaction_timestamp timestamp, risk_level string, action string, "
                "reason_description string")


def fraud_alerts(spark, per_customer):
    rows = []
    for cust, n in per_customer.items():
        for i in range(n):
            rows.append((f"FRAUD-{cust}-{i:04d}", "FRAUD_WATCHLIST_MATCH", f"{cust}@x", cust,
                         f"T{i}", 10.0 + i, "USD", "Shop <&>", "purchase", "City", "US",
                         datetime(2024, 1, 1), "HIGH", "BLOCK", "reason"))
    return spark.createDataFrame(rows, ALERT_SCHEMA)


def test_one_digest_per_customer_with_its_full_count(spark):
    df = fraud_alerts(spark, {"hot": 1000, "small": 3, "single": 1})
    digests = {d.recipient_name: d for d in alerts.fraud_digests(df).collect()}
    assert {k: d.alert_count for k, d in digests.items()} == {"hot": 1000, "small": 3, "single": 1}
    assert digests["hot"].subject.endswith("1000 Detected")
    assert all(d.body.count(alerts.LINES_MARK) == 1 for d in digests.values())
    lines = alerts.fraud_digest_lines(df).collect()
    assert len({x.alert_id for x in lines}) == len(lines) == 1004
    assert sum(x.recipient_name == "hot" for x in lines) == 1000


def test_digest_plan_reads_its_input_once_and_collects_no_lists(spark):
    for render in (alerts.fraud_digests, alerts.fraud_digest_lines):
        plan = explain_text(render(fraud_alerts(spark, {"a": 2})), "simple")
        assert plan.count("Scan") == 1 and "collect_list" not in plan


def test_values_are_escaped_and_amounts_plain(spark):
    df = fraud_alerts(spark, {"a<b>": 1}).withColumn("transaction_timestamp", F.lit(
        "2024-01-01 10:00:00.25").cast("timestamp"))
    assert "Dear a&lt;b&gt;," in alerts.fraud_digests(df).first().body
    row = alerts.fraud_digest_lines(df).first().row_html
    assert "Shop &lt;&amp;&gt;" in row and "<td>10.0 USD</td>" in row
    assert "<td>2024-01-01 10:00:00.250000</td>" in row


def test_null_recipient_is_its_own_group(spark):
    df = fraud_alerts(spark, {"a": 2}).withColumn("customer_email", F.lit(None).cast("string"))
    got = alerts.fraud_digests(df).collect()
    assert len(got) == 1 and got[0].alert_count == 2 and got[0].recipient is None


def records(spark, ids):
    rows = [(i, "4000", "CARD", "high", "block", "R", "d", "01-Jan-2024 00:00:00", "x", "y",
             "c", "US") for i in ids]
    return spark.createDataFrame(rows, WATCHLIST_RECORD)


def test_high_water_mark_is_numeric(spark):
    hwm = feed.high_water_mark(records(spark, ["WL000009", "WL000010", "WL9", "WLx", "bad"]))
    row = hwm.first()
    assert (row.max_id_num, row.latest_watchlist_id) == (10, "WL000010")


def test_new_records_and_rejects(spark):
    fed = records(spark, ["WL000001", "WL000010", "WL000011", "WL12", "oops"])
    assert [r.watchlist_id for r in feed.new_records(fed, 10).collect()] == ["WL000011", "WL12"]
    assert feed.new_records(fed, None).count() == 5       # nothing delivered yet: all
    assert [r.watchlist_id for r in feed.rejected_records(fed, 10).collect()] == ["oops"]
    assert feed.rejected_records(fed, None).count() == 0


def test_feed_columns_are_found_by_name(spark, tmp_path):
    names = WATCHLIST_RECORD.fieldNames()
    order = ["entity_id", *[c for c in names if c not in ("entity_id", "watchlist_id")], "extra",
             "watchlist_id"]
    value = {c: c for c in order} | {"watchlist_id": "WL7", "entity_id": "4000",
                                     "reason_description": '"said ""hi"",\nagain"'}
    path = tmp_path / "feed.csv"
    path.write_text(",".join(order) + "\n" + ",".join(value[c] for c in order) + "\n")
    row = read_watchlist_csv(spark, str(path)).collect()
    assert len(row) == 1 and (row[0].watchlist_id, row[0].entity_id) == ("WL7", "4000")
    assert row[0].reason_description == 'said "hi",\nagain' and row[0].extra == "extra"
    path.write_text("entity_id,city\n4000,x\n")
    with pytest.raises(ValueError, match="watchlist_id"):
        read_watchlist_csv(spark, str(path))


def test_deliver_resumes_after_mark(spark):
    run = new_run(spark, "test_feed")
    csv_path, folder = run.staging("csv"), run.staging("drop")
    records(spark, [f"WL{i:06d}" for i in range(1, 21)]).write.option("header", True).csv(csv_path)
    records(spark, [f"WL{i:06d}" for i in range(1, 8)]).write.json(folder)
    first = sorted(r.watchlist_id for r in feed.deliver(spark, csv_path, folder).collect())
    assert first == [f"WL{i:06d}" for i in range(8, 21)]
    assert feed.deliver(spark, csv_path, folder).count() == 0   # everything delivered
    assert feed.delivered_records(spark, folder).count() == 20


def test_deliver_into_empty_folder(spark):
    run = new_run(spark, "test_feed_empty")
    csv_path = run.staging("csv")
    records(spark, ["WL000001", "WL000002"]).write.option("header", True).csv(csv_path)
    assert feed.deliver(spark, csv_path, run.staging("drop")).count() == 2
