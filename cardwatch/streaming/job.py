"""Run the pipeline as a job.

    python -m cardwatch.streaming.job \\
        --root s3a://bucket/cardwatch --bootstrap-servers host:9092 --topic transactions \\
        --credentials-file /secure/kafka.json --watchlist-folder s3a://bucket/watchlist \\
        [--customers-parquet s3a://bucket/customers_load] [--processing-time "1 minute"]

Without ``--processing-time`` every step runs once over the available input
(schedule the job); with it all steps keep running on that trigger.
``--root`` defaults to a folder below ``spark.checkpoint.dir``.
The credentials file is JSON with ``api_key`` and ``api_secret``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ..config import CLUSTER_STREAMING, shared_root
from ..schemas import CUSTOMER
from ..sources.kafka import kafka_options, read_kafka
from . import pipeline


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="cardwatch.streaming.job")
    p.add_argument("--root", help="folder of the pipeline tables")
    p.add_argument("--bootstrap-servers", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--credentials-file", help="JSON with api_key and api_secret")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--min-partitions", type=int)
    p.add_argument("--watchlist-folder", required=True)
    p.add_argument("--customers-parquet", help="a customer master load to append first")
    p.add_argument("--processing-time", help='e.g. "1 minute"; omit for one availableNow run')
    p.add_argument("--max-match-age", help="opt-in time bound of the watchlist match")
    p.add_argument("--all-customer-rows", action="store_true",
                   help="join every row of a customer id, not only the latest")
    p.add_argument("--max-files-per-trigger", type=int,
                   help="files of an input table a micro-batch takes at most")
    p.add_argument("--match-salts", type=int, default=pipeline.Layout.match_salts,
                   help="state partitions per card of the match (fixed for a checkpoint)")
    p.add_argument("--allow-data-loss", action="store_true",
                   help="go on when the topic no longer has the next offsets")
    p.add_argument("--state-store", choices=["rocksdb", "default"], default="rocksdb",
                   help="state store for new checkpoints (an existing one keeps its own)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("cardwatch").getOrCreate()
    if args.state_store == "rocksdb":
        for key, value in CLUSTER_STREAMING.items():
            spark.conf.set(key, value)
    credentials = {}
    if args.credentials_file:
        with open(args.credentials_file) as f:
            credentials = json.load(f)
    options = kafka_options(args.bootstrap_servers, args.topic,
                            api_key=credentials.get("api_key"),
                            api_secret=credentials.get("api_secret"),
                            max_offsets_per_trigger=args.max_offsets_per_trigger,
                            min_partitions=args.min_partitions,
                            fail_on_data_loss=not args.allow_data_loss)
    layout = pipeline.Layout(args.root or f"{shared_root(spark)}/cardwatch/pipeline",
                             processing_time=args.processing_time,
                             max_files_per_trigger=args.max_files_per_trigger,
                             match_salts=args.match_salts)
    if args.customers_parquet:
        customers = spark.read.schema(CUSTOMER).parquet(args.customers_parquet)
        pipeline.land_customers(spark, layout, customers)
    gold_options = {"max_match_age": args.max_match_age,
                    "latest_customers": not args.all_customer_rows}
    envelope = read_kafka(spark, options)
    if args.processing_time:
        pipeline.start_all(spark, layout, envelope=envelope,
                           watchlist_folder=args.watchlist_folder, **gold_options)
        spark.streams.awaitAnyTermination()
    else:
        pipeline.run_once(spark, layout, envelope=envelope,
                          watchlist_folder=args.watchlist_folder, **gold_options)


if __name__ == "__main__":
    main()
