"""Transaction stream from a Kafka topic.

The connector jar is not part of this image, so ``read_kafka`` is only
exercised on a cluster that ships it; tests replay Kafka-shaped rows with
``replay_envelope`` instead (same columns, same types).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KAFKA_ENVELOPE


def kafka_options(bootstrap_servers: str, topic: str, *, api_key: str | None = None,
                  api_secret: str | None = None, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None, fail_on_data_loss: bool = True,
                  login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
                  ) -> dict[str, str]:
    """Reader options for a topic, SASL_SSL/PLAIN when credentials are given.

    Credentials are passed in by the caller (from whatever secret store the
    platform has); nothing here looks them up.  ``max_offsets_per_trigger``
    bounds a micro-batch so one backlog cannot make a batch unbounded.
    Offsets that the topic no longer has stop the query, unless
    ``fail_on_data_loss`` is false: then they are skipped without notice.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if api_key is not None:
        options.update({
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config":
                f'{login_module} required username="{api_key}" password="{api_secret}";',
        })
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        # split large topic partitions so a micro-batch uses every core
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka topic as an unbounded stream of envelope rows."""
    return spark.readStream.format("kafka").options(**options).load()


def replay_envelope(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None,
                    partitions: int | None = None) -> DataFrame:
    """Kafka-shaped rows replayed from parquet files (tests, backfills).

    ``partitions`` plays the role of the Kafka source's ``minPartitions``:
    a micro-batch read from few files is spread over that many tasks.
    """
    reader = spark.readStream.schema(KAFKA_ENVELOPE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(path)
    return stream.repartition(partitions) if partitions else stream
