"""Source adapters: Kafka options, replay, watchlist folder."""

import pytest

from cardwatch import config
from cardwatch.schemas import KAFKA_ENVELOPE, WATCHLIST_RECORD
from cardwatch.sources import files, kafka, testdata
from cardwatch.sources.jdbc import hash_predicates
from cardwatch.streaming.job import parse_args


def test_kafka_options_with_and_without_credentials():
    plain = kafka.kafka_options("broker:9092", "tx")
    assert plain["subscribe"] == "tx" and plain["startingOffsets"] == "earliest"
    assert "kafka.sasl.jaas.config" not in plain
    secure = kafka.kafka_options("broker:9092", "tx", api_key="k", api_secret="s",
                                 max_offsets_per_trigger=1000, min_partitions=64)
    assert secure["kafka.security.protocol"] == "SASL_SSL"
    assert secure["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="k" password="s";' in secure["kafka.sasl.jaas.config"]
    assert (secure["maxOffsetsPerTrigger"], secure["minPartitions"]) == ("1000", "64")


def test_replay_has_kafka_columns(spark, sf_dir, tmp_path):
    testdata.kafka_envelope(testdata.read_table(spark, sf_dir, "events")) \
        .write.parquet(str(tmp_path / "env"))
    stream = kafka.replay_envelope(spark, str(tmp_path / "env"), partitions=4)
    assert stream.isStreaming and stream.schema == KAFKA_ENVELOPE


def test_kafka_stops_on_lost_data_unless_told_otherwise():
    assert kafka.kafka_options("b:9092", "tx")["failOnDataLoss"] == "true"
    assert kafka.kafka_options("b:9092", "tx", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_watchlist_reads_every_file_and_rescues_the_rest(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "a.json").write_text('{"watchlist_id": "WL000001", "entity_id": 4000, "new": [1]}\n\n')
    (folder / "b.txt").write_text('{"watchlist_id": "WL000002", "entity_id": "4001"}\nbroken {\n[1]\n')
    lines = spark.read.text(str(folder)).selectExpr("value", "_metadata.file_path as source_file")
    got = {(r.watchlist_id, r.entity_id, r.rescued_data) for r in files.watchlist_lines(lines).collect()}
    assert got == {("WL000001", "4000", '{"new":"[1]"}'), ("WL000002", "4001", None),
                   (None, None, "broken {"), (None, None, "[1]")}
    stream = files.watchlist_stream(spark, str(folder))
    assert stream.isStreaming and stream.columns == [*WATCHLIST_RECORD.fieldNames(), "rescued_data",
                                                     "source_file"]
    assert files.read_watchlist_files(spark, str(folder)).filter("watchlist_id is not null").count() == 2


def test_jdbc_predicates_split_by_hash():
    assert hash_predicates("abs(hashtext(customer_id))", 2) == [
        "mod(abs(hashtext(customer_id)), 2) = 0", "mod(abs(hashtext(customer_id)), 2) = 1"]


def test_shared_root_without_a_setting(spark):
    """A local session gets one folder per process; any other is an error."""
    class Session:
        sparkContext = None

        def __init__(self, master):
            self.conf = {"spark.master": master}
    assert config.shared_root(Session("local[2]")) == config.shared_root(Session("local"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        config.shared_root(Session("local-cluster[2,1,1024]"))


def test_job_arguments():
    args = parse_args(["--bootstrap-servers", "b:9092", "--topic", "tx",
                       "--watchlist-folder", "/w", "--processing-time", "1 minute"])
    assert args.processing_time == "1 minute" and args.root is None
    assert not args.all_customer_rows and not args.allow_data_loss
