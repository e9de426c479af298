"""The late-row gate, chained windows and the table whose columns follow what arrives."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from cardwatch.config import new_run
from cardwatch.operators import gold
from cardwatch.sources.files import watchlist_lines
from cardwatch.schemas import RESCUED, WATCHLIST_RECORD
from cardwatch.streaming.evolving import EvolvingTable, fits, wider
from cardwatch.streaming.late import late_gate
from cardwatch.streaming.ledger import Ledger
from cardwatch.streaming.runner import run_to_table, rows_dropped_by_watermark

TX = "transaction_id string, transaction_timestamp timestamp"


def at(hms):
    return datetime.fromisoformat(f"2024-01-01 {hms}") if hms else None


BATCHES = [[("a", "10:00:30"), ("b", "10:10:00")],
           [("c", "10:01:00"), ("d", "10:20:00"), ("n", None)],
           [("e", "10:02:00"), ("f", "10:14:30"), ("g", "10:15:30")],
           []]


def ledgers(spark, name):
    run = new_run(spark, name)
    shape = spark.createDataFrame([], TX).schema
    return run, [Ledger(spark, run.table(t), shape).create() for t in ("on_time", "late")]


def test_gate_lists_every_late_row_and_a_replay_changes_nothing(spark):
    _, (on_time, late) = ledgers(spark, "test_gate")
    gate = late_gate(on_time, late, "tx")
    batches = [spark.createDataFrame([(i, at(t)) for i, t in rows], TX) for rows in BATCHES]
    for number in (0, 1, 1, 2, 0, 3):
        gate(batches[number], number)
    # c: window ends 10:02, watermark 10:05; e and f: watermark 10:15; g's window ends 10:16.
    assert sorted(r[0] for r in late.read().collect()) == ["c", "e", "f"]
    assert sorted(r[0] for r in on_time.read().collect()) == ["a", "b", "d", "g", "n"]


def test_gate_survives_a_crash_between_its_commits(spark):
    _, (on_time, late) = ledgers(spark, "test_gate_crash")
    batches = [spark.createDataFrame([(i, at(t)) for i, t in rows], TX) for rows in BATCHES]
    late_gate(on_time, late, "tx")(batches[0], 0)

    class Dies(Ledger):
        def append(self, *args):
            raise RuntimeError("lost")

    dying = Dies(spark, on_time.root, on_time.schema)
    try:
        late_gate(dying, late, "tx")(batches[1], 1)
    except RuntimeError:
        pass
    late_gate(on_time, late, "tx")(batches[1], 1)
    assert [r[0] for r in late.read().collect()] == ["c"]
    assert sorted(r[0] for r in on_time.read().collect()) == ["a", "b", "d", "n"]


def test_counts_behind_the_gate_drop_nothing_and_both_forms_agree(spark):
    run, (on_time, late) = ledgers(spark, "test_gate_counts")
    gate = late_gate(on_time, late, "tx")
    staged = run.staging("tx")
    for number, rows in enumerate(BATCHES):
        gate(spark.createDataFrame([(i, at(t)) for i, t in rows], TX), number)
    on_time.read().write.parquet(staged)
    results = {}
    for name, count in (("direct", gold.sliding_transaction_counts), ("chained", gold.chained_sliding_counts)):
        stream = spark.readStream.schema(TX).option("maxFilesPerTrigger", 1).parquet(staged)
        progress = run_to_table(count(stream), run.table(name), run.checkpoint(name), partitions=2)
        assert rows_dropped_by_watermark(progress) == 0
        results[name] = sorted(map(tuple, spark.read.parquet(run.table(name)).collect()))
    assert results["direct"] == results["chained"] != []
    batch = on_time.read()
    assert (sorted(map(tuple, gold.chained_sliding_counts(batch).collect()))
            == sorted(map(tuple, gold.sliding_transaction_counts(batch).collect())))


def lines(spark, *records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    rows = spark.createDataFrame([(t, "f") for t in texts], "value string, source_file string")
    return watchlist_lines(rows)


def shown(table):
    columns = [c for c in table.read().columns if c not in WATCHLIST_RECORD.names or c == "watchlist_id"]
    return {r[0]: r.asDict() for r in table.read().select(*columns).collect()}


def test_fields_are_promoted_and_types_only_widen(spark):
    table = EvolvingTable(spark, new_run(spark, "test_evolving").table("w"), WATCHLIST_RECORD)
    assert table.promote() == {}
    first = lines(spark, {"watchlist_id": "1", "score": 7, "zip": "007", "ok": True, "City": "x", "a b": 1},
                  {"watchlist_id": "2", "score": 8}, '{"watchlist_id": "3", "cut')
    assert table.append(first, "feed", 0) and not table.append(first, "feed", 0)
    assert RESCUED in table.read().columns and "score" not in table.read().columns
    assert table.promote() == {"ok": "boolean", "score": "bigint", "zip": "string"}
    assert table.promote() == {"ok": "boolean", "score": "bigint", "zip": "string"}     # nothing new
    # The batch is known although it lies in an earlier version.
    assert not table.append(first, "feed", 0)
    table.append(lines(spark, {"watchlist_id": "4", "score": 1.5, "ok": "maybe", "zip": "08"},
                       {"watchlist_id": "5", "score": 9}), "feed", 1)
    got = shown(table)
    # What does not fit yet stays under its name.
    assert json.loads(got["4"][RESCUED]) == {"score": "1.5", "ok": "maybe"} and got["4"]["score"] is None
    assert table.promote() == {"ok": "string", "score": "double", "zip": "string"}
    got = shown(table)
    assert {k: got[k]["score"] for k in "1245"} == {"1": 7.0, "2": 8.0, "4": 1.5, "5": 9.0}
    assert (got["1"]["ok"], got["4"]["ok"], got["1"]["zip"], got["4"]["zip"]) == ("true", "maybe", "007", "08")
    assert json.loads(got["1"][RESCUED]) == {"City": "x", "a b": "1"}
    assert got["4"][RESCUED] is None
    assert got[None][RESCUED] == '{"watchlist_id": "3", "cut'


def test_large_integers_do_not_become_doubles(spark):
    table = EvolvingTable(spark, new_run(spark, "test_evolving_wide").table("w"), WATCHLIST_RECORD)
    table.append(lines(spark, {"watchlist_id": "1", "n": 2 ** 53 + 1}), "feed", 0)
    assert table.promote() == {"n": "bigint"}
    table.append(lines(spark, {"watchlist_id": "2", "n": 0.5}), "feed", 1)
    assert table.promote() == {"n": "string"}
    assert {k: v["n"] for k, v in shown(table).items()} == {"1": str(2 ** 53 + 1), "2": "0.5"}


def test_columns_are_bounded_and_names_differ_by_more_than_case(spark):
    table = EvolvingTable(spark, new_run(spark, "test_evolving_many").table("w"), WATCHLIST_RECORD, max_fields=2)
    table.append(lines(spark, {"watchlist_id": "1", "x": 1, "X": 2, "y": 1, "z": 1},
                       {"watchlist_id": "2", "X": 3, "z": 5}), "feed", 0)
    assert table.promote() == {"X": "bigint", "z": "bigint"}
    assert json.loads(shown(table)["1"][RESCUED]) == {"x": "1", "y": "1"}


def test_fits_and_wider(spark):
    texts = ["1", "007", "-0", "1.5", "1e3", "true", "TRUE", "", "NaN", str(2 ** 63), "0x1"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select(
        "v", *[F.coalesce(fits(F.col("v"), k), F.lit(False)).alias(k) for k in ("bigint", "double", "boolean")])
    got = {r["v"]: {k for k in ("bigint", "double", "boolean") if r[k]} for r in rows.collect()}
    assert got == {"1": {"bigint", "double"}, "007": set(), "-0": {"double"}, "1.5": {"double"}, "1e3": {"double"},
                   "true": {"boolean"}, "TRUE": set(), "": set(), "NaN": set(), str(2 ** 63): set(), "0x1": set()}
    assert wider("bigint", "double") == wider("double", "bigint") == "double"
    assert wider("boolean", "bigint") == "string" and wider("string", "double") == "string"
