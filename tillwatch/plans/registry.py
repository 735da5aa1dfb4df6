"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tillwatch.plans import batch, stream

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: tuple[Query, ...] = (
    batch.event_class_counts,
    batch.render_messages,
    batch.encode_envelope,
    batch.decode_envelope,
    batch.validate_required,
    batch.quarantine_counts,
    batch.accepted_with_faults,
    batch.event_time_parse,
    batch.parse_message,
    batch.parse_untidy_message,
    batch.enriched_events,
    batch.minute_totals,
    batch.sparse_totals,
    batch.payment_failure_alerts,
    batch.refund_volume_alerts,
    batch.all_alerts,
    batch.hourly_partition_roundtrip,
    batch.daily_agg_roundtrip,
    stream.stream_enriched_append,
    stream.stream_quarantine,
    stream.stream_minute_totals,
    stream.stream_alerts,
    stream.stream_late_drop,
    stream.stream_late_enriched,
    batch.alerts_none,
    batch.extreme_times_totals,
    batch.far_future_totals,
    batch.control_character_roundtrip,
    stream.stream_running_totals,
    stream.stream_repeated_alerts,
    stream.stream_both_queries,
    stream.stream_empty_batches,
    stream.stream_merged_files,
    stream.stream_processing_time,
    stream.stream_dropped_events,
    batch.exact_amount_alerts,
    batch.validate_by_schema_id,
    stream.restarted_totals,
    stream.continued_totals,
    stream.stream_chained_totals,
    stream.stream_event_log,
    stream.stream_event_log_quarantine,
    stream.merged_hours,
    stream.stream_batch_counts,
    stream.awaited_failure,
    stream.stream_late_counts,
)


def _in_utc(query: Query) -> Query:
    """Run a query in a UTC session, as its event times and SQL counterpart need.

    The session stays in UTC: its result is computed after the query returns.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {query.__name__: _in_utc(query) for query in _QUERIES}
