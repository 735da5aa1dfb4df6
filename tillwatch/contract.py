"""The data contract: fixed values, schemas and defaults every module shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class EventKind:
    action: str
    level: str
    weight: int
    template: str


# Event actions, levels, shares in percent and message templates.
EVENT_KINDS = (
    EventKind(
        "payment_successful", "INFO", 81,
        "Payment successful for order {order_id}. Amount: ${amount:.2f}. User: {user_id}. Payment ID: {payment_id}. IP: {ip}",
    ),
    EventKind(
        "refund_processed", "INFO", 9,
        "Refund processed for order {order_id}. Amount: ${amount:.2f}. User: {user_id}. Refund ID: {refund_id}. IP: {ip}",
    ),
    EventKind(
        "payment_failed", "ERROR", 9,
        "Payment FAILED for order {order_id}. Amount: ${amount:.2f}. User: {user_id}. Reason: {reason}. IP: {ip}",
    ),
    EventKind(
        "refund_failed", "ERROR", 1,
        "Refund FAILED for order {order_id}. Amount: ${amount:.2f}. User: {user_id}. Reason: {reason}. IP: {ip}",
    ),
)

# The reasons a failed event can give.
FAILURE_REASONS = (
    "Insufficient funds",
    "Card declined",
    "Expired card",
    "Invalid CVC",
    "Payment gateway error",
    "Transaction blocked by bank",
)

# The second word that marks a failed event.
FAILED_WORD = "FAILED"

# Topic, watermark delay, window length, trigger and alert limits.
TOPIC = "payment"
WATERMARK_DELAY = "5 seconds"
WINDOW_LENGTH = "1 minute"
TRIGGER_INTERVAL = "1 minute"
# Fixed value: partitions of the topic.
TOPIC_PARTITIONS = 3
ALERT_MIN_COUNT = 10
ALERT_EXACT_AMOUNT = 10000.0

# The alert texts (count, then amount).
PAYMENT_ALERT_TEXT = "ALERT: High Payment error rate! %d errors with $%.2f."
REFUND_ALERT_TEXT = "ALERT: High Refund requests rate! %d requests with $%.2f$."

# Names, order and types of all fields below.
EVENT_FIELDS = ("timestamp", "level", "message")

KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

PARSED_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("is_failed", T.BooleanType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("payment_id", T.StringType()),
        T.StructField("fail_reason", T.StringType()),
    ]
)

ENRICHED_SCHEMA = T.StructType(
    [T.StructField("event_time", T.TimestampType()), T.StructField("level", T.StringType()), *PARSED_SCHEMA]
)

TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("type", T.StringType()),
        T.StructField("is_failed", T.BooleanType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

ALERT_SCHEMA = T.StructType(
    [*TOTALS_SCHEMA, T.StructField("rule", T.StringType()), T.StructField("alert_message", T.StringType())]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("stage", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
