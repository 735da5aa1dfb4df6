"""Defective, untidy and incomplete versions of the order log, chosen by order key.

They give the validation, quarantine and parsing queries rows of every kind;
all orders are in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.contract import KAFKA_SCHEMA
from tillwatch.functions.text import WHITESPACE
from tillwatch.functions.wire import frame
from tillwatch.operators.render import payment_events, render_log

VARIANTS = 17
# 2024-01-01, when the order log begins.
EPOCH_SECONDS = 1_704_067_200


def faulty_records(orders: DataFrame, schema_id: int = 1) -> DataFrame:
    """Records of the order log, most of them with one defect."""
    log = render_log(payment_events(orders))
    texts = {name: F.col(name) for name in ("timestamp", "level", "message")}

    def framed(**changed: Column | str | None) -> Column:
        return frame(event_json(texts | changed), schema_id)

    good = framed()
    order_id = F.regexp_extract("message", r"(order_\w+)", 1)
    versions = {
        3: F.lit(None).cast("binary"),
        4: F.concat(F.unhex(F.lit("01")), F.substring(good, 2, 2**31 - 1)),
        5: F.substring(good, 1, 3),
        6: F.concat(good, F.unhex(F.lit("FF"))),
        7: F.substring(good, F.lit(1), F.octet_length(good) - 1),
        8: F.concat(good, F.lit(" trailing").cast("binary")),
        9: framed(timestamp="5"),
        10: framed(level="null"),
        11: framed(message=None),
        12: framed(timestamp=F.lit("garbage")),
        13: framed(message=F.lit("Payment successful")),
        14: framed(message=F.regexp_replace("message", r"\$[0-9.]+ ", r"\$x. ")),
        15: framed(message=F.concat(F.lit("Payment successful for order "), order_id, F.lit(". Amount: $1.00. User: u. Payment ID:"))),
        16: frame(F.concat(F.lit('{"extra":[1,{"level":2}],'), F.substr(event_json(texts), F.lit(2))), schema_id),
    }
    version = F.pmod("order_key", F.lit(VARIANTS))
    value = F
    for number, changed in versions.items():
        value = value.when(version == number, changed)
    return log.select(
        F.col("action").cast("binary").alias("key"),
        value.otherwise(good).alias("value"),
        F.lit("payment").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("order_key").alias("offset"),
        F.col("event_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).select(*KAFKA_SCHEMA.names)


def _renewed(log: DataFrame, schema_id: int = 1, **changed: Column) -> DataFrame:
    """Records of a log with some texts replaced, written by ``to_json`` so that any text is escaped."""
    texts = {name: F.col(name) for name in ("timestamp", "level", "message")} | changed
    payload = F.to_json(F.struct(*[text.alias(name) for name, text in texts.items()]))
    return log.select(
        F.col("action").cast("binary").alias("key"),
        frame(payload, schema_id).alias("value"),
        F.lit("payment").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("order_key").alias("offset"),
        F.col("event_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).select(*KAFKA_SCHEMA.names)


# Both ends of what a timestamp can hold, and a far but ordinary time.
EXTREME_TIMES = ("+294247-01-10T04:00:54.775807Z", "-290308-12-21T19:59:05.224192Z", "9999-06-30T12:00:30Z")


def extreme_times(orders: DataFrame) -> DataFrame:
    """Records of all orders, some of them at an end of the time range or in the year 9999."""
    log = render_log(payment_events(orders))
    time = F
    for version, text in enumerate(EXTREME_TIMES, 1):
        time = time.when(F.pmod("order_key", F.lit(VARIANTS)) == version, text)
    return _renewed(log, timestamp=time.otherwise(F.col("timestamp")))


def future_times(orders: DataFrame) -> DataFrame:
    """Records of all orders, some of them with a time an hour and some with a time centuries after their record's."""
    log = render_log(payment_events(orders))
    version = F.pmod("order_key", F.lit(VARIANTS))
    later = F.concat(F.date_format(F.col("event_time") + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return _renewed(log, timestamp=F.when(version == 1, "9999-01-01T00:00:00Z").when(version == 2, later).otherwise(F.col("timestamp")))


CONTROL_TEXTS = ("A\nB", "\r", "\r\n", '"\n"', "\t", "\x00", "\x01", "\x00\x01a\x01b", "", ' " ', "\\", ",")


def control_characters(orders: DataFrame) -> DataFrame:
    """Records of all orders with line breaks, quotes, tabs, NUL and the like as their level."""
    log = render_log(payment_events(orders))
    level = F.get(F.array(*map(F.lit, CONTROL_TEXTS)), F.pmod("order_key", F.lit(len(CONTROL_TEXTS))).cast("int"))
    return _renewed(log, level=level)


# Orders whose amounts add up to the same round total.
EXACT_GROUP = 20
EXACT_CENTS = 1_000_000


def exact_amounts(orders: DataFrame) -> DataFrame:
    """Failed payments in which each 20 orders share a minute of their own and total exactly 10000.00: the last one takes what is left."""
    group = F.floor(F.col("o_orderkey") / EXACT_GROUP)
    cents = F.rint(F.col("o_totalprice") * 100).cast("long") % 50_000
    grouped = orders.select("o_orderkey", group.alias("group"), cents.alias("cents"))
    window = Window.partitionBy("group")
    last = F.col("o_orderkey") == F.max("o_orderkey").over(window)
    others = F.sum("cents").over(window) - F.col("cents")
    taken = F.when(last, EXACT_CENTS - others).otherwise(F.col("cents"))
    return grouped.select(
        (F.lit(EPOCH_SECONDS) + F.col("group") * 60).cast("timestamp").alias("event_time"),
        F.lit("Payment").alias("type"),
        F.lit(True).alias("is_failed"),
        (taken / 100).alias("amount"),
    )


# Required fields of two kinds of records in one topic.
TWO_SCHEMAS = (
    *[(1, name, "string") for name in ("timestamp", "level", "message")],
    (2, "order", "integer"),
    (2, "weight", "number"),
    (2, "customer", "object"),
    (2, "tags", "array"),
)


def two_schemas(orders: DataFrame) -> DataFrame:
    """Records of two schemas, some of them with a field missing or of another type, or under a wrong or unknown schema id; by order key modulo 11."""
    log = render_log(payment_events(orders)).join(orders.select(F.col("o_orderkey").alias("order_key"), "o_custkey"), "order_key")
    texts = {name: F.col(name) for name in ("timestamp", "level", "message")}
    key, customer = F.col("order_key").cast("string"), F.concat(F.lit(',"customer":{"id":'), F.col("o_custkey").cast("string"), F.lit("}"))

    def order(number: Column = key, customer: Column = customer, tags: str = "[1,2]") -> Column:
        return F.concat(F.lit('{"order":'), number, customer, F.lit(f',"weight":1.5,"tags":{tags}}}'))

    versions = {
        4: frame(event_json(texts | {"level": "5"}), 1),
        5: frame(order(), 2),
        6: frame(order(number=F.concat(F.lit('"'), key, F.lit('"'))), 2),
        7: frame(order(customer=F.lit("")), 2),
        8: frame(order(), 9),
        9: frame(order(), 1),
        10: frame(order(tags="null"), 2),
    }
    version, value = F.pmod("order_key", F.lit(11)), F
    for number, changed in versions.items():
        value = value.when(version == number, changed)
    return log.select("order_key", value.otherwise(frame(event_json(texts), 1)).alias("value"))


def event_json(fields: dict[str, Column | str | None]) -> Column:
    """JSON text of an event: columns as strings, ``str`` as raw JSON, None left out."""
    members = []
    for name, content in fields.items():
        if content is None:
            continue
        if isinstance(content, str):
            members.append(F.lit(f'"{name}":{content}'))
        else:
            members.append(F.concat(F.lit(f'"{name}":"'), content, F.lit('"')))
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def untidy_messages(log: DataFrame) -> DataFrame:
    """Messages with other separators, more of them, and more dots and dollar signs."""
    separators = F.array(*[F.lit(char + " " + char) for char in WHITESPACE])
    separator = F.get(separators, F.pmod("order_key", F.lit(len(WHITESPACE))).cast("int"))
    marked = F.replace(F.replace(F.col("message"), F.lit("$"), F.lit("$$$")), F.lit(". "), F.lit("... "))
    spread = F.concat(separator, F.replace(marked, F.lit(" "), separator), F.lit(".."), separator)
    return log.withColumn("message", spread)


TIME_FORMS = 8


def time_texts(events: DataFrame) -> DataFrame:
    """Event times in every accepted form, and two texts that are no time."""
    time = F.col("event_time")
    day_time = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    forms = [
        F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")),
        F.concat(day_time, F.lit("+00:00")),
        F.concat(day_time, F.lit("Z")),
        F.concat(day_time, F.lit("+02:30")),
        F.date_format(time, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(time, "yyyy-MM-dd"),
        F.lit("garbage"),
        F.lit(""),
    ]
    form = F.pmod("order_key", F.lit(TIME_FORMS)).cast("int")
    return events.select("order_key", F.get(F.array(*forms), form).alias("time_text"))


def sparse_events(events: DataFrame) -> DataFrame:
    """Enriched columns of the totals with missing times, keys and amounts."""
    key = F.col("order_key")

    def unless(divisor: int, column: Column) -> Column:
        return F.when(F.pmod(key, F.lit(divisor)) != 0, column)

    action = F.split("action", "_")
    return events.select(
        unless(13, F.col("event_time")).alias("event_time"),
        unless(7, F.initcap(F.get(action, F.lit(0)))).alias("type"),
        unless(5, F.get(action, F.lit(1)) == "failed").alias("is_failed"),
        unless(3, F.col("amount")).alias("amount"),
    )
