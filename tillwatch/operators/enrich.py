"""From records to enriched events and to the quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.contract import ENRICHED_SCHEMA, PARSED_SCHEMA, QUARANTINE_SCHEMA, WATERMARK_DELAY, WINDOW_LENGTH
from tillwatch.functions.event_time import has_window, parse_event_time
from tillwatch.operators.decode import decode_fields
from tillwatch.operators.parse import parse_fields

ENRICHED_COLUMNS = tuple(ENRICHED_SCHEMA.names)
QUARANTINE_COLUMNS = tuple(QUARANTINE_SCHEMA.names)

# A record without a usable event time cannot enter a window, yet its fields
# are whole: it stays among the enriched events and is reported as well.
TIME_STAGE = "time"
STAGES = ("frame", "utf8", "json", "schema", "parse", TIME_STAGE)


def classify_records(
    records: DataFrame,
    known_schema_ids: Sequence[int] | None = None,
    window_length: str = WINDOW_LENGTH,
    max_ahead: str | None = None,
) -> DataFrame:
    """All records with the enriched columns and, for defective ones, ``stage`` and ``error``.

    A time so near the ends of the time range that no window of
    ``window_length`` fits around it is a defect of the time: it would end the
    totals with an overflow. With ``max_ahead``, so is a time further than that ahead
    of the record's own ``timestamp`` (of the broker); a single one moves
    the watermark and with it shuts out all events after it. By default times ahead are taken as they are.
    """
    decoded = decode_fields(records, known_schema_ids)
    time = parse_event_time(F.col("event_timestamp"))
    timed = decoded.withColumn("_time", time)
    fits = has_window(F.col("_time"), window_length)
    time_error = F.when(F.col("_time").isNull(), "timestamp is not a time").when(~fits, "timestamp has no window")
    if max_ahead is not None:
        limit = F.col("timestamp") + F.lit(max_ahead).cast("interval")
        time_error = time_error.when(F.coalesce(F.col("_time") > limit, F.lit(False)), "timestamp is too far ahead")
    timed = timed.withColumn("_time_error", time_error)
    timed = timed.withColumn("event_time", F.when(F.col("_time_error").isNull(), F.col("_time")))
    parsed = parse_fields(timed, F.col("event_message"))
    unparsed = F.struct(F.lit("parse").alias("stage"), F.col("parse_error").alias("error"))
    untimed = F.struct(F.lit(TIME_STAGE).alias("stage"), F.col("_time_error").alias("error"))
    defect = (
        F.when(F.col("defect").isNotNull(), F.col("defect"))
        .when(F.col("parse_error").isNotNull(), unparsed)
        .when(F.col("event_time").isNull(), untimed)
    )
    return parsed.withColumn("defect", defect).select(
        *[F.col(name) for name in records.columns],
        "event_time",
        F.col("event_level").alias("level"),
        *PARSED_SCHEMA.names,
        F.col("defect.stage").alias("stage"),
        F.col("defect.error").alias("error"),
    )


def is_accepted() -> Column:
    return F.col("stage").isNull() | (F.col("stage") == TIME_STAGE)


def is_defective() -> Column:
    return F.col("stage").isNotNull()


def keep_rows(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """``df.where(condition).select(columns)`` that evaluates ``df`` once per row.

    The optimizer pushes a filter below the projections it depends on, which
    would decode and parse each record in the filter and again after it. A
    generator of no or one row per input row stays where it is.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def accepted_events(classified: DataFrame, columns: Sequence[str] = ENRICHED_COLUMNS) -> DataFrame:
    """Enriched events; name fewer ``columns`` to compute fewer fields."""
    return keep_rows(classified, is_accepted(), columns)


def quarantined_records(classified: DataFrame, columns: Sequence[str] = QUARANTINE_COLUMNS) -> DataFrame:
    return keep_rows(classified, is_defective(), columns)


def with_watermark(events: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Bound how late an event may arrive; without effect on a batch."""
    return events.withWatermark("event_time", delay)
