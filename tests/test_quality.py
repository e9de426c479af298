"""Expectations: drop and warn semantics, metrics on batches and streams."""

from pyspark.sql import Observation

from cardwatch.config import new_run
from cardwatch.operators import quality as Q
from cardwatch.operators.silver import TRANSACTION_EXPECTATIONS
from cardwatch.sources import testdata
from cardwatch.streaming.runner import run_to_table


def frame(spark):
    return spark.createDataFrame(
        [("a", 1.0), (None, 2.0), ("c", None), ("d", -1.0), (None, None)], "id string, amount double")


def test_drop_and_warn(spark):
    exps = [Q.expect_or_drop("has_id", "id IS NOT NULL"), Q.expect("positive", "amount > 0")]
    obs = Observation("m")
    kept = Q.apply_expectations(frame(spark), exps, obs)
    assert sorted(r.id for r in kept.collect()) == ["a", "c", "d"]
    # counts are over every input row, NULL amount counts as a failure
    assert obs.get == {"rows": 5, "has_id": 2, "positive": 3}


def test_report_matches_observation(spark):
    exps = [Q.expect_or_drop("has_id", "id IS NOT NULL"), Q.expect("positive", "amount > 0")]
    rows = {r.expectation: r for r in Q.expectation_report(frame(spark), exps).collect()}
    assert (rows["has_id"].failed_rows, rows["has_id"].action, rows["has_id"].total_rows) == (
        2, "drop", 5)
    assert rows["positive"].failed_rows == 3


def test_unknown_action_rejected():
    try:
        Q.Expectation("x", "true", "fail")
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_stream_metrics_equal_batch_report(spark, sf_dir):
    """observe() on a stream reports the same counts as the batch report."""
    stream = testdata.dirty_transactions(testdata.events_stream(spark, sf_dir))
    checked = Q.apply_expectations(stream, TRANSACTION_EXPECTATIONS, "dirty")
    run = new_run(spark, "test_stream_metrics")
    progress = run_to_table(checked, run.table("t"), run.checkpoint("t"))
    streamed = Q.metrics_from_progress(progress, "dirty")
    batch = testdata.dirty_transactions(testdata.read_table(spark, sf_dir, "events"))
    report = {r.expectation: r.failed_rows for r in
              Q.expectation_report(batch, TRANSACTION_EXPECTATIONS).collect()}
    assert streamed.pop("rows") == batch.count()
    assert streamed == report
    kept = spark.read.parquet(run.table("t")).count()
    assert kept == batch.count() - report["valid_customer_id"]
