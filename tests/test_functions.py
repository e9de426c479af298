from datetime import date, datetime

from pyspark.sql import functions as F

from cardwatch.functions import expressions as X


def one(spark, col, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_alert_id_skips_null_parts(spark):
    df = spark.createDataFrame([("T1", "WL1"), ("T2", None), (None, None)], "t string, w string")
    got = [r.a for r in df.select(X.alert_id("FRAUD", "t", "w").alias("a")).collect()]
    assert got == ["FRAUD-T1-WL1", "FRAUD-T2", "FRAUD"]


def test_full_name_skips_null(spark):
    df = spark.createDataFrame([("Ada", "Lovelace"), ("Ada", None)], "f string, l string")
    assert [r.n for r in df.select(X.full_name("f", "l").alias("n")).collect()] == [
        "Ada Lovelace", "Ada"]


def test_watchlist_time_parse(spark):
    cases = {
        "05-Jan-2025 10:11:12": datetime(2025, 1, 5, 10, 11, 12),
        "05-JAN-2025 10:11:12": datetime(2025, 1, 5, 10, 11, 12),
        "05-jan-2025 10:11:12": datetime(2025, 1, 5, 10, 11, 12),
        "5-Jan-2025 10:11:12": None,       # one-digit day
        "2025-01-05 10:11:12": None,       # ISO text
        None: None,
    }
    for text, want in cases.items():
        assert one(spark, X.parse_watchlist_time(F.col("v")), text) == want, text


def test_open_date_parse(spark):
    assert one(spark, X.parse_open_date(F.col("v")), "2021-03-04") == date(2021, 3, 4)
    assert one(spark, X.parse_open_date(F.col("v")), "2020-02-30") is None
    assert one(spark, X.parse_open_date(F.col("v")), "04/03/2021") is None


def test_watchlist_number(spark):
    cases = {"WL000010": 10, "WL000009": 9, "WL9": 9, "WLx": None, "bad": None,
             "wl000005": None, "WL": None, None: None}
    for text, want in cases.items():
        assert one(spark, X.watchlist_number(F.col("v")), text) == want, text


def test_money_and_yes_no(spark):
    assert one(spark, X.money(F.col("v")), 1234567.5, "v double") == "1,234,567.50"
    assert one(spark, X.money(F.col("v")), 0.5, "v double") == "0.50"
    assert one(spark, X.yes_no(F.col("v")), True, "v boolean") == "Yes"
    assert one(spark, X.yes_no(F.col("v")), False, "v boolean") == "No"
    assert one(spark, X.yes_no(F.col("v")), None, "v boolean") == "No"


def test_html_text_escapes(spark):
    assert one(spark, X.html_text(F.col("v")), 'a<b>&"c"') == "a&lt;b&gt;&amp;&quot;c&quot;"
    assert one(spark, X.html_text(F.col("v")), None) == ""


def test_wall_clock_round_trip(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 0, 0),)], "t timestamp_ntz")
    back = X.wall_clock(df.select(X.event_time("t").alias("t")))
    assert back.schema["t"].dataType.typeName() == "timestamp_ntz"
    assert back.first()["t"] == datetime(2024, 1, 1, 10, 0, 0)
