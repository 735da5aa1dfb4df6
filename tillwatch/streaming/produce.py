"""Write the payment records of an orders table to a topic or to record files.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \\
        --py-files tillwatch.zip tillwatch/streaming/produce.py \\
        --tables /shared/tables --bootstrap-servers host:9092
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tillwatch.contract import TOPIC, TOPIC_PARTITIONS
from tillwatch.operators.render import order_records
from tillwatch.session import build_session
from tillwatch.sources.files import append_records
from tillwatch.sources.kafka import KafkaTarget
from tillwatch.sources.tables import read_orders, stream_orders
from tillwatch.streaming.run import option


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description="Payment records from an orders table.")
    args.add_argument("--tables", required=True, help="folder with orders.parquet")
    args.add_argument("--schema-id", type=int, default=1)
    target = args.add_mutually_exclusive_group(required=True)
    target.add_argument("--bootstrap-servers", help="message brokers, host:port,…")
    target.add_argument("--files", help="folder of record files instead of a topic")
    args.add_argument("--topic", default=TOPIC)
    args.add_argument("--spread-over", type=int, default=TOPIC_PARTITIONS, help="number of topic partitions to fill evenly")
    args.add_argument("--by-key", action="store_true", help="let the record key choose the partition; most records share one")
    args.add_argument("--target-option", action="append", type=option, default=[], help="NAME=VALUE for the connector; repeatable")
    args.add_argument("--stream", metavar="CHECKPOINT", help="follow files added to the table instead of writing it once")
    return args


def target_of(args: argparse.Namespace) -> KafkaTarget:
    spread = None if args.by_key else args.spread_over
    return KafkaTarget(args.bootstrap_servers, args.topic, spread, dict(args.target_option))


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("tillwatch-produce")
    orders = stream_orders(spark, args.tables) if args.stream else read_orders(spark, args.tables)
    records = order_records(orders, args.schema_id)
    if args.files and args.stream:
        files = records.writeStream.format("parquet").option("path", args.files)
        files.option("checkpointLocation", args.stream).trigger(availableNow=True).start().awaitTermination()
    elif args.files:
        append_records(records, args.files)
    else:
        target = target_of(args)
        if args.stream:
            target.stream_writer(records, args.stream).start().awaitTermination()
        else:
            target.batch_writer(records).save()


if __name__ == "__main__":
    main()
