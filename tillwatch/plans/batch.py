"""Registered queries that run as batch jobs over the orders table."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwatch.contract import ENRICHED_SCHEMA, PARSED_SCHEMA, TOTALS_SCHEMA
from tillwatch.functions.event_time import parse_event_time
from tillwatch.operators.alerts import (
    DEFAULT_RULES,
    PAYMENT_FAILURES,
    REFUND_VOLUME,
    AlertRule,
    find_alerts,
    with_limits,
)
from tillwatch.operators.decode import decode_records
from tillwatch.operators.enrich import accepted_events, classify_records, quarantined_records
from tillwatch.operators.parse import parse_messages
from tillwatch.operators.render import encode_log, order_records, payment_events, render_log
from tillwatch.operators.schemas import SCHEMA_TABLE, decode_by_schema
from tillwatch.operators.totals import TOTALS_INPUT, flat_totals, window_totals
from tillwatch.plans.variants import (
    TWO_SCHEMAS,
    control_characters,
    exact_amounts,
    extreme_times,
    faulty_records,
    future_times,
    sparse_events,
    time_texts,
    two_schemas,
    untidy_messages,
)
from tillwatch.session import work_dir
from tillwatch.sinks.batches import BatchFolders, glance, stamp
from tillwatch.sources.tables import read_orders


def presentable(df: DataFrame) -> DataFrame:
    """Zone-less times and cent-rounded totals, as the SQL counterparts give them."""
    changes = {name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"}
    if "total_amount" in df.columns:
        changes["total_amount"] = F.round("total_amount", 2)
    return df.withColumns(changes)


def event_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = render_log(payment_events(read_orders(spark, sf_dir)))
    return log.groupBy("action", "level").agg(F.count("*").alias("event_count"))


def render_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = render_log(payment_events(read_orders(spark, sf_dir)))
    return log.select("order_key", "action", "timestamp", "level", "message")


def encode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode_log(render_log(payment_events(read_orders(spark, sf_dir))), schema_id=258)
    return records.select(
        F.col("offset").alias("order_key"),
        "topic",
        F.col("key").cast("string").alias("record_key"),
        F.hex("value").alias("value_hex"),
    )


def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_records(order_records(read_orders(spark, sf_dir), schema_id=258))
    return decoded.select(
        F.col("offset").alias("order_key"), "schema_id", "event.timestamp", "event.level", "event.message"
    )


def validate_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_records(faulty_records(read_orders(spark, sf_dir)))
    return decoded.select(
        F.col("offset").alias("order_key"), "event.level", "event.message", "defect.stage", "defect.error"
    )


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = classify_records(faulty_records(read_orders(spark, sf_dir)))
    rejected = quarantined_records(classified, ("stage", "error"))
    return rejected.groupBy("stage", "error").agg(F.count("*").alias("record_count"))


def accepted_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(accepted_events(classify_records(faulty_records(read_orders(spark, sf_dir)))))


def event_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = time_texts(payment_events(read_orders(spark, sf_dir)))
    return presentable(texts.select("order_key", "time_text", parse_event_time(F.col("time_text")).alias("event_time")))


def _parsed(log: DataFrame) -> DataFrame:
    parsed = parse_messages(log, F.col("message"))
    fields = [F.col(f"parsed.{name}").alias(name) for name in PARSED_SCHEMA.names]
    return parsed.select("order_key", *fields, "parse_error")


def parse_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(render_log(payment_events(read_orders(spark, sf_dir))))


def parse_untidy_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(untidy_messages(render_log(payment_events(read_orders(spark, sf_dir)))))


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(accepted_events(classify_records(order_records(read_orders(spark, sf_dir)))))


def order_totals(orders: DataFrame) -> DataFrame:
    """Window totals of the order log, through its wire records."""
    events = accepted_events(classify_records(order_records(orders)), TOTALS_INPUT)
    return flat_totals(window_totals(events))


def minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(order_totals(read_orders(spark, sf_dir)))


def sparse_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sparse_events(payment_events(read_orders(spark, sf_dir)))
    return presentable(flat_totals(window_totals(events)))


def _alerts(spark: SparkSession, sf_dir: str, *rules: AlertRule) -> DataFrame:
    return presentable(find_alerts(order_totals(read_orders(spark, sf_dir)), rules))


def payment_failure_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, PAYMENT_FAILURES)


def refund_volume_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, REFUND_VOLUME)


def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, *DEFAULT_RULES)


def alerts_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits that no total reaches: the table of alerts is empty."""
    return _alerts(spark, sf_dir, *with_limits(10**15, None))


def extreme_times_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times that no window fits around are in no total and stop nothing."""
    classified = classify_records(extreme_times(read_orders(spark, sf_dir)))
    return presentable(flat_totals(window_totals(accepted_events(classified, TOTALS_INPUT))))


def far_future_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a limit of two hours ahead, events centuries ahead are in no total, those one hour ahead are."""
    classified = classify_records(future_times(read_orders(spark, sf_dir)), max_ahead="2 hours")
    return presentable(flat_totals(window_totals(accepted_events(classified, TOTALS_INPUT))))


def _written_twice(folders: BatchFolders, rows: DataFrame, schema: StructType) -> DataFrame:
    """What the sink holds after a batch and its replay."""
    batch = stamp(rows, F.lit(datetime.now(timezone.utc)))
    summary = glance(batch)
    for _ in range(2):
        folders.write(batch, batch_id=0, summary=summary)
    return presentable(folders.read(rows.sparkSession, schema).select(*schema.names))


def hourly_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = accepted_events(classify_records(order_records(read_orders(spark, sf_dir))))
    return _written_twice(BatchFolders(work_dir(spark, "hourly"), hourly=True), events, ENRICHED_SCHEMA)


def daily_agg_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # small rows that took all the decoding: kept between the two writes
    totals = order_totals(read_orders(spark, sf_dir)).persist()
    try:
        return _written_twice(BatchFolders(work_dir(spark, "daily")), totals, TOTALS_SCHEMA)
    finally:
        totals.unpersist()


def control_character_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose level holds line breaks, quotes, NUL and the like, through the CSV sink."""
    events = accepted_events(classify_records(control_characters(read_orders(spark, sf_dir))))
    found = _written_twice(BatchFolders(work_dir(spark, "control"), hourly=True), events, ENRICHED_SCHEMA)
    return found.withColumn("level", F.hex(F.encode("level", "UTF-8")))


# In how many tasks the same amounts are added up.
SUM_TASKS = (1, 7, 64)


def exact_amount_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts on an exact total, from amounts that reach it in whatever order and number of tasks they are added."""
    events = exact_amounts(read_orders(spark, sf_dir))
    rules = [replace(PAYMENT_FAILURES, min_count=10**15)]
    found = [find_alerts(flat_totals(window_totals(events.repartition(tasks))), rules).withColumn("tasks", F.lit(tasks)) for tasks in SUM_TASKS]
    return presentable(reduce(DataFrame.union, found))


def validate_by_schema_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two schemas in one topic, each checked by its own."""
    decoded = decode_by_schema(two_schemas(read_orders(spark, sf_dir)), spark.createDataFrame(TWO_SCHEMAS, SCHEMA_TABLE))
    fields = [F.element_at("fields", name).alias(f"{name}_text") for name in ("message", "order", "weight", "customer", "tags")]
    return decoded.select("order_key", "schema_id", "defect.stage", "defect.error", *fields)
