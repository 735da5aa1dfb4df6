"""Run the streaming queries over a topic until one of them ends.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \\
        --py-files tillwatch.zip tillwatch/streaming/run.py \\
        --bootstrap-servers host:9092 --output /shared/out --checkpoint /shared/checkpoints
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillwatch.contract import (
    ALERT_EXACT_AMOUNT,
    ALERT_MIN_COUNT,
    TOPIC,
    TRIGGER_INTERVAL,
    WATERMARK_DELAY,
    WINDOW_LENGTH,
)
from tillwatch.operators.alerts import with_limits
from tillwatch.session import build_session
from tillwatch.sinks.ledger import MAIN
from tillwatch.sources.files import stream_records
from tillwatch.sources.kafka import MAX_OFFSETS_PER_TRIGGER, MIN_PARTITIONS, KafkaSource
from tillwatch.streaming.jobs import StreamConfig, await_any, start_all, start_chained


# A window holds a handful of groups, and each part of the state commits at each trigger.
STATE_PARTITIONS = 8


def option(text: str) -> tuple[str, str]:
    """``NAME=VALUE`` of a connector option."""
    name, equals, value = text.partition("=")
    if not name or not equals:
        raise argparse.ArgumentTypeError(f"not NAME=VALUE: {text}")
    return name, value


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description="Enrich payment events, total them per window and raise alerts.")
    source = args.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap-servers", help="message brokers, host:port,…")
    source.add_argument("--replay", help="folder of record files instead of a topic")
    args.add_argument("--topic", default=TOPIC)
    args.add_argument("--starting-offsets", default="earliest", help="only for the first start")
    args.add_argument(
        "--fail-on-data-loss",
        action=argparse.BooleanOptionalAction,
        default=True,
        help="stop if the topic no longer holds the next offsets; switched off, these records are left out of all results",
    )
    args.add_argument("--min-partitions", type=int, default=MIN_PARTITIONS, help="tasks to split the topic partitions into")
    args.add_argument("--max-offsets-per-trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER, help="records of one batch")
    args.add_argument("--source-option", action="append", type=option, default=[], help="NAME=VALUE for the connector; repeatable")
    args.add_argument("--max-files-per-trigger", type=int, help="with --replay")
    args.add_argument("--output", required=True, help="root folder of all results")
    args.add_argument("--checkpoint", required=True, help="root folder of both checkpoints")
    args.add_argument("--format", choices=("csv", "parquet"), default="csv")
    args.add_argument("--enriched-files", type=int, help="files per batch of enriched events; default one per task")
    args.add_argument("--no-quarantine", action="store_true", help="do not keep defective records")
    args.add_argument("--schema-id", type=int, action="append", help="accept only this schema id; repeatable")
    args.add_argument("--trigger", default=TRIGGER_INTERVAL)
    args.add_argument("--once", action="store_true", help="process what is there, then stop")
    args.add_argument("--watermark", default=WATERMARK_DELAY)
    args.add_argument("--window", default=WINDOW_LENGTH)
    args.add_argument("--alert-count", type=int, default=ALERT_MIN_COUNT)
    args.add_argument("--alert-amount", type=float, default=ALERT_EXACT_AMOUNT)
    args.add_argument("--max-ahead", help="longest time that an event may lie ahead of its record, e.g. '1 hour'")
    args.add_argument("--lineage", default=MAIN, help="name of the results that a new checkpoint over an old output belongs to")
    args.add_argument(
        "--continues", action="store_true", help="a new checkpoint goes on behind the records of the one before it, instead of replacing its results"
    )
    args.add_argument("--chained", action="store_true", help="decode once into an event log in Parquet, and total that; instead of the enriched files")
    args.add_argument("--totals-files", type=int, default=1, help="files per batch of totals and of alerts")
    args.add_argument(
        "--shuffle-partitions", type=int, default=STATE_PARTITIONS, help="parts of the state; fixed for good by the first start"
    )
    return args


def config_of(args: argparse.Namespace) -> StreamConfig:
    return StreamConfig(
        output_root=args.output,
        checkpoint_root=args.checkpoint,
        trigger={"availableNow": True} if args.once else {"processingTime": args.trigger},
        watermark_delay=args.watermark,
        window_length=args.window,
        rules=with_limits(args.alert_count, args.alert_amount),
        known_schema_ids=args.schema_id,
        quarantine=not args.no_quarantine,
        format=args.format,
        enriched_files=args.enriched_files,
        totals_files=args.totals_files,
        max_ahead=args.max_ahead,
        lineage=args.lineage,
        continues=args.continues,
    )


def records_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.replay:
        return stream_records(spark, args.replay, args.max_files_per_trigger)
    source = KafkaSource(
        args.bootstrap_servers,
        args.topic,
        args.starting_offsets,
        args.fail_on_data_loss,
        min_partitions=args.min_partitions,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        extra=dict(args.source_option),
    )
    return source.stream(spark)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("tillwatch", streaming=True, spark__sql__shuffle__partitions=str(args.shuffle_partitions))
    start = start_chained if args.chained else start_all
    queries = start(records_of(spark, args), config_of(args))
    if args.once:
        for query in queries:
            query.awaitTermination()
    else:
        await_any(spark)


if __name__ == "__main__":
    main()
