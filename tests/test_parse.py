"""Permissive JSON parsing of message values and the silver drop rules."""

from datetime import datetime

from pyspark.sql import functions as F

from cardwatch.operators import bronze, silver

GOOD = ('{"transaction_id":"T1","customer_id":"C1","card_number":"4000","merchant_id":"M1",'
        '"amount":12.5,"transaction_timestamp":"2024-01-01 00:00:00","is_international":true}')


def envelope(spark, values):
    rows = [(None if v is None else bytearray(v.encode()), i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "value binary, offset long")
    return df.select(F.lit(None).cast("binary").alias("key"), "value",
                     F.lit("transactions").alias("topic"), F.lit(0).alias("partition"),
                     "offset", F.current_timestamp().alias("timestamp"),
                     F.lit(0).alias("timestampType"))


def parsed(spark, values):
    out = silver.parse_transactions(bronze.bronze_transactions(envelope(spark, values)))
    return {r.kafka_offset: r for r in out.collect()}


def test_well_formed_and_lineage(spark):
    r = parsed(spark, [GOOD])[0]
    assert (r.transaction_id, r.amount, r.is_international) == ("T1", 12.5, True)
    assert r.transaction_timestamp == datetime(2024, 1, 1)
    assert r.kafka_topic == "transactions" and r.kafka_partition == 0


def test_unparseable_values_give_all_null(spark):
    rows = parsed(spark, ["garbage", "{}", "[" + GOOD + "]", None, ""])
    for offset in range(4):
        assert rows[offset].transaction_id is None and rows[offset].amount is None
    assert rows[4].transaction_id is None


def test_wrong_field_types(spark):
    rows = parsed(spark, [
        GOOD.replace('"amount":12.5', '"amount":"abc"'),
        GOOD.replace('"amount":12.5', '"amount":"5.5"'),
        GOOD.replace('"is_international":true', '"is_international":"true"'),
        GOOD.replace('"transaction_id":"T1"', '"transaction_id":3'),
        GOOD.replace('"2024-01-01 00:00:00"', '1704067200'),
        GOOD.replace('"2024-01-01 00:00:00"', '"05-Jan-2025"'),
        GOOD.replace('"transaction_id"', '"Transaction_ID"'),
        GOOD + " trailing text",
    ])
    assert rows[0].amount is None and rows[0].transaction_id == "T1"
    assert rows[1].amount is None
    assert rows[2].is_international is None
    assert rows[3].transaction_id == "3"
    assert rows[4].transaction_timestamp == datetime(2024, 1, 1)
    assert rows[5].transaction_timestamp is None
    assert rows[6].transaction_id is None
    assert rows[7].transaction_id == "T1"


def test_silver_drops_rows_missing_ids(spark):
    values = [GOOD, "garbage", GOOD.replace('"merchant_id":"M1",', ""),
              GOOD.replace('"amount":12.5', '"amount":-1')]
    out = silver.silver_transactions(bronze.bronze_transactions(envelope(spark, values)))
    kept = sorted(r.kafka_offset for r in out.collect())
    assert kept == [0, 3]          # negative amount is warned, not dropped
    assert "silver_ingestion_timestamp" in out.columns


def test_silver_watchlist_uppercases_and_parses(spark):
    df = spark.createDataFrame(
        [("wl000001", "4000", "CARD", "high", "block", "R1", "d", "05-jan-2024 10:00:00",
          "x", "y", "c", "US")],
        "watchlist_id string, entity_id string, watch_type string, risk_level string, "
        "action string, reason_code string, reason_description string, effective_from string, "
        "reported_by string, reported_source string, city string, country string")
    r = silver.silver_watchlist(df.withColumn("ingestion_timestamp", F.current_timestamp())).first()
    assert (r.watchlist_id, r.risk_level, r.action) == ("WL000001", "HIGH", "BLOCK")
    assert r.effective_from == datetime(2024, 1, 5, 10, 0, 0)
    assert r.bronze_ingestion_timestamp is not None
