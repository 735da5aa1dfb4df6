"""Payment events from an order table, as log rows and as wire records."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.contract import EVENT_KINDS, FAILURE_REASONS, TOPIC
from tillwatch.functions.event_time import render_event_time
from tillwatch.functions.message import render_template, weighted_choice
from tillwatch.functions.text import zero_pad
from tillwatch.functions.wire import frame

LOG_START = datetime(2024, 1, 1, tzinfo=timezone.utc)
EVENT_SPACING_MS = 50


def payment_events(orders: DataFrame) -> DataFrame:
    """One payment event per order, with every field a function of its row."""
    key = F.col("o_orderkey")

    def scatter(factor: int, size: int) -> Column:
        # reduced before multiplying: no key is too large
        return F.pmod(key, F.lit(size)) * factor % size

    padded_key = zero_pad(key, 16)
    return orders.select(
        key.alias("order_key"),
        weighted_choice(scatter(37, 100), [(kind.action, kind.weight) for kind in EVENT_KINDS]).alias("action"),
        F.timestamp_millis(F.lit(int(LOG_START.timestamp()) * 1000) + key * EVENT_SPACING_MS).alias("event_time"),
        F.concat(F.lit("order_"), zero_pad(key, 12)).alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.concat(F.lit("user_"), zero_pad(F.col("o_custkey"), 6)).alias("user_id"),
        F.concat(F.lit("pay_"), padded_key).alias("payment_id"),
        F.concat(F.lit("ref_"), padded_key).alias("refund_id"),
        F.get(
            F.array(*[F.lit(reason) for reason in FAILURE_REASONS]),
            F.pmod(key, F.lit(len(FAILURE_REASONS))).cast("int"),
        ).alias("reason"),
        F.concat_ws(
            ".", F.pmod(key, F.lit(223)) + 1, scatter(7, 256), scatter(11, 256), scatter(13, 254) + 1
        ).alias("ip"),
    )


def render_log(events: DataFrame) -> DataFrame:
    """Log rows: order key, action, and the three text fields of a log event."""
    fields = {name: F.col(name) for name in events.columns}
    message, level = F, F
    for kind in EVENT_KINDS:
        chosen = F.col("action") == kind.action
        message = message.when(chosen, render_template(kind.template, fields))
        level = level.when(chosen, kind.level)
    return events.select(
        "order_key",
        "action",
        "event_time",
        render_event_time(F.col("event_time")).alias("timestamp"),
        level.alias("level"),
        message.alias("message"),
    )


def encode_log(log: DataFrame, schema_id: int = 1, topic: str = TOPIC) -> DataFrame:
    """Records as the message broker hands them out, keyed by action."""
    event_json = F.to_json(F.struct("timestamp", "level", "message"))
    return log.select(
        F.col("action").cast("binary").alias("key"),
        frame(event_json, schema_id).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("order_key").alias("offset"),
        F.col("event_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def order_records(orders: DataFrame, schema_id: int = 1) -> DataFrame:
    return encode_log(render_log(payment_events(orders)), schema_id)
