"""Ledgers: crashes, replays, compaction and pruning; current rows, delta matches, delivery, committed counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardwatch.config import new_run
from cardwatch.operators import alerts, current, delivery, gold, silver
from cardwatch.operators.quality import expect, expect_or_drop, observed_expectations
from cardwatch.streaming import delta
from cardwatch.streaming.ledger import Ledger
from cardwatch.streaming.runner import finish, start_foreach_batch
from tests.conftest import explain_text

ROWS = "id long, day date, amount double"


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def batch(spark, ids, days=3):
    return spark.createDataFrame([(i, day(i % days) if i % 10 else None, float(i)) for i in ids], ROWS)


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.fixture
def table(spark):
    return Ledger(spark, new_run(spark, "test-ledger").table("t"), batch(spark, []).schema, ("day",)).create()


def test_rows_count_once_committed(spark, table):
    assert ids(table.read()) == []
    assert table.append(batch(spark, range(6)), "s", 0)
    assert not table.append(batch(spark, range(6)), "s", 0)             # a replay
    table._write(batch(spark, range(50, 60)), "a0", "died")             # a crash before the commit
    assert table.append(batch(spark, []), "s", 1)                       # no rows, but done
    assert table.committed("s", 1) and not table.committed("s", 2)
    assert table.append(batch(spark, range(6, 9)), "other", 0)
    assert ids(table.read()) == list(range(9))
    assert table.read().columns == ["id", "day", "amount"]
    assert ids(table.read(since=1)) == [6, 7, 8] and ids(table.read(upto=1)) == list(range(6))


def test_two_commits_of_a_batch_count_once(spark, table):
    """A writer that was thought dead commits the same batch after its successor."""
    table.append(batch(spark, range(6)), "s", 0)
    parts = table._write(batch(spark, range(6)), "a0", "zombie")
    table._commit(parts, "a0", "zombie", 2, "s", 0, "append", None, {"rows": 6})
    assert ids(table.read()) == list(range(6))
    table.compact(1)
    assert ids(table.read()) == list(range(6))


def test_compaction_keeps_rows_and_versions(spark, table):
    for b in range(4):
        table.append(batch(spark, range(5 * b, 5 * b + 5)), "s", b)
    table._write(batch(spark, range(90, 95)), "a0", "died")
    before = ids(table.read())
    # A compaction that dies before its commit changes nothing, the next one does its work.
    table._write(table.tagged(), "c5-died", None)
    assert ids(table.read()) == before
    assert len(table.compact()) == 4 and table.compact() == []
    assert ids(table.read()) == before == list(range(20))
    table.append(batch(spark, range(20, 23)), "s", 4)
    assert not table.append(batch(spark, range(5)), "s", 0)
    assert ids(table.read()) == list(range(23))
    assert ids(table.read(since=2, upto=3)) == list(range(10, 15))
    assert ids(table.read(since=3)) == list(range(15, 23))
    assert len(table.compact(1)) >= 3 and ids(table.read()) == list(range(23))


def test_readers_prune_folders(spark, table):
    for b in range(3):
        table.append(batch(spark, range(5 * b, 5 * b + 5)), "s", b)
    table.compact()
    one_day = table.read().filter(F.col("day") == day(1))
    plan = explain_text(one_day, "formatted")
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all("day" in f and "_gen" in f for f in filters)
    assert ids(one_day) == [i for i in range(15) if i % 3 == 1 and i % 10]


def test_many_batches_few_folders(spark):
    outbox = delivery.outbox_ledger(spark, new_run(spark, "test-outbox").table("outbox"))
    message = spark.createDataFrame([("a@x", "A", "s", "b", 1)],
                                    "recipient string, recipient_name string, subject string, body string, "
                                    "alert_count long")
    sink = delivery.indexed_sink(outbox, "high_value", lambda b: b)
    for b in range(12):
        sink(message, b)
    sink(message, 3)
    assert delivery.messages(outbox).count() == 12
    folders = {os.path.dirname(os.path.join(d, f)) for d, _, fs in os.walk(outbox.data) for f in fs
               if f.endswith(".parquet") and not f.startswith(".")}
    assert len({f for f in folders if "kind=message" in f}) <= 2        # one, or two around midnight


def test_followers_see_each_batch_once(spark, table):
    run, seen = new_run(spark, "test-follow"), []
    table.append(batch(spark, range(6)), "s", 0)
    table.append(batch(spark, range(6, 9)), "s", 1)
    follow = lambda: finish(table.follow(lambda rows, b: seen.extend(ids(rows)), run.checkpoint("f")), spark)
    follow()
    assert sorted(seen) == list(range(9))
    table.compact()
    table.append(batch(spark, range(9, 11)), "s", 2)
    table._write(batch(spark, range(90, 95)), "a0", "died")
    follow()
    assert sorted(seen) == list(range(11))


# -- counts committed with their batch ----------------------------------------------------

def test_counts_are_exact_when_a_batch_dies_between_rows_and_commit(spark, monkeypatch):
    run = new_run(spark, "test-quality")
    for i in range(3):
        batch(spark, range(10 * i, 10 * i + 10)).write.parquet(run.staging(f"in/part={i}"))
    stream = (spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 2).option("recursiveFileLookup", "true")
              .parquet(run.staging("in")))
    table = Ledger(spark, run.table("t"), batch(spark, []).schema).create()
    rules = [expect_or_drop("dated", "day IS NOT NULL"), expect("large", "amount > 5")]
    handler = observed_expectations(table, rules, "s")
    commit, died = Ledger._commit, []

    def dying(self, *args):
        if not died:
            died.append(True)
            raise RuntimeError("lost between rows and commit")
        return commit(self, *args)

    monkeypatch.setattr(Ledger, "_commit", dying)
    with pytest.raises(Exception, match="lost between"):
        finish(start_foreach_batch(stream, handler, run.checkpoint("q")), spark)
    finish(start_foreach_batch(stream, handler, run.checkpoint("q")), spark)
    totals = {r["metric"]: r["value"] for r in table.metrics().groupBy("metric").agg(
        F.sum("value").alias("value")).collect()}
    assert totals == {"rows": 30, "dated": 3, "large": 6}
    assert ids(table.read()) == [i for i in range(30) if i % 10]


# -- current rows ------------------------------------------------------------------------

LOAD = "customer_id string, city string, update_timestamp timestamp"


def load(spark, *rows):
    return spark.createDataFrame([(k, c, t and dt.datetime(2024, 1, t)) for k, c, t in rows], LOAD)


def current_rows(table):
    return sorted((r["customer_id"], r["city"]) for r in table.read().collect())


def test_loads_rewrite_only_touched_buckets(spark):
    table = current.current_table(spark, new_run(spark, "test-current").table("c"), load(spark).schema)
    merge = lambda n, *rows: current.merge_load(table, load(spark, *rows), "customer_id", "update_timestamp", n,
                                                buckets=16)
    first = [(str(i), "A", 1) for i in range(40)]
    assert len(merge(0, *first, (None, "lost", 1))) > 5
    assert merge(0, ("1", "other", 9)) == []                 # the same load again
    assert merge(1, *first) == []                            # repeated rows
    assert len(merge(2, ("7", "B", 2), ("7", "older", 1), ("8", "stale", None))) == 1
    assert merge(3, *first) == []                            # A, B, A: B's times are later
    assert len(merge(4, ("7", "C", 2), ("new", "N", None))) in (1, 2)
    want = {str(i): "A" for i in range(40)} | {"7": "C", "new": "N"}
    assert current_rows(table) == sorted(want.items())


def test_pruned_join_neither_repeats_nor_shuffles_the_customers(spark, sf_dir):
    from cardwatch.plans import catalog
    from cardwatch.sources import testdata
    table = catalog._current_customers(spark, sf_dir, new_run(spark, "test-pruned").table("c"), 1)
    tx = testdata.transactions(spark.read.parquet(f"{sf_dir}/events.parquet")).filter("customer_id < '2'")
    rows = current.needed_rows(table, tx, "customer_id", "customer_id", ["customer_id", "email"], buckets=8)
    plan = explain_text(rows, "formatted")
    scans = [b for b in plan.split("\n\n") if "Scan parquet" in b and "_bucket" in b]
    assert scans and all("_bucket" in s.split("PartitionFilters")[1] for s in scans)
    assert "BroadcastHashJoin" in plan and "Generate" not in plan and "SortMergeJoin" not in plan
    assert "_salt" not in plan
    wanted = {r[0] for r in tx.select("customer_id").distinct().collect()}
    assert {r["customer_id"] for r in rows.collect()} <= wanted


# -- delta matches -----------------------------------------------------------------------

def matched(spark, sf_dir, order, age=None):
    """Match keys after deliveries of ('t' or 'w', third) in this order, a step after each, one of them repeated."""
    from cardwatch.sources import testdata
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tx, entries = testdata.transactions(events), silver.silver_watchlist(testdata.watchlist_records(events))
    run = new_run(spark, "test-delta")
    t = delta.transaction_ledger(spark, run.table("t"), tx.schema)
    w = Ledger(spark, run.table("w"), entries.schema).create()
    columns = ["transaction_id", "watchlist_id"]
    out = Ledger(spark, run.table("m"), tx.crossJoin(entries.select("watchlist_id")).select(*columns).schema).create()
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(3))
    for side, n in order:
        if side == "t":
            t.append(delta.placed(tx.filter(part("transaction_id") == n), 2), "t", n)
        else:
            w.append(entries.filter(part("watchlist_id") == n), "w", n)
        for _ in range(2 if n == 1 else 1):
            delta.match_step(t, w, out, max_match_age=age, buckets=2, finish=lambda m: m.select(*columns))
        if n == 2:
            t.compact()
    found = sorted(map(tuple, out.read().collect()))
    plain = tx.join(gold.watchlist_side(entries), F.col("card_number") == F.col("entity_id"))
    if age:
        plain = plain.filter(F.col("transaction_timestamp").between(
            F.col("effective_from"), F.col("effective_from") + F.expr(f"INTERVAL {age}")))
    return found, sorted(map(tuple, plain.select(*columns).collect()))


@pytest.mark.parametrize("order, age", [
    ([("w", 0), ("t", 0), ("t", 1), ("w", 1), ("w", 2), ("t", 2)], None),
    ([("t", 2), ("w", 2), ("t", 0), ("w", 1)], "3 days"),
])
def test_delta_matches_equal_one_join(spark, sf_dir, order, age):
    full = order if len(order) == 6 else [*order, *[(s, n) for s in "tw" for n in range(3) if (s, n) not in order]]
    found, want = matched(spark, sf_dir, full, age)
    assert found == want and found


# -- delivery ------------------------------------------------------------------------------

def test_acknowledgements_are_idempotent(spark):
    outbox = spark.createDataFrame([("f", 0, f"r{i}", "s") for i in range(5)],
                                   "flow string, batch_id long, recipient string, subject string")
    key = {r["recipient"]: r["message_id"] for r in outbox.withColumn("message_id", delivery.message_id()).collect()}
    now = dt.datetime(2024, 1, 1)
    acks = [(key["r0"], "delivered", now), (key["r0"], "delivered", now), (key["r1"], "failed", now),
            (key["r1"], "delivered", now), (key["r2"], "failed", now), (key["r2"], "failed", None),
            ("unknown", "failed", now), (key["r3"], "odd", now), (None, "delivered", now)]
    log = spark.createDataFrame(acks, delivery.ACKNOWLEDGEMENT)
    assert [tuple(r) for r in delivery.delivery_tally(outbox, log).collect()] == [("f", 0, 5, 2, 1, 2)]
    assert sorted(r["recipient"] for r in delivery.unsent(outbox, log).collect()) == ["r3", "r4"]
    assert sorted(r["recipient"] for r in delivery.unsent(outbox, log, retry_failed=True).collect()) == ["r2", "r3", "r4"]
    assert [tuple(r)[2:] for r in delivery.delivery_tally(outbox, log.limit(0)).collect()] == [(5, 0, 0, 5)]


def test_outbox_rows_hold_messages_and_lines(spark, sf_dir):
    from cardwatch.plans import catalog
    outbox = catalog._indexed_outbox(spark, sf_dir, new_run(spark, "test-outbox"))
    fraud = catalog._batch_fraud(spark, sf_dir)
    assert delivery.lines(outbox).count() == fraud.count()
    assert delivery.messages(outbox).filter(F.col("flow") == alerts.FRAUD_FLOW).count() == \
        fraud.select("customer_email", "customer_name").distinct().count()
