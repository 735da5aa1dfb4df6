"""The two streaming queries: enriched events, and totals with alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.contract import TRIGGER_INTERVAL, WATERMARK_DELAY, WINDOW_LENGTH
from tillwatch.operators.alerts import DEFAULT_RULES, AlertRule, find_alerts
from tillwatch.operators.enrich import (
    ENRICHED_COLUMNS,
    QUARANTINE_COLUMNS,
    STAGES,
    accepted_events,
    classify_records,
    is_accepted,
    is_defective,
    keep_rows,
    with_watermark,
)
from tillwatch.operators.totals import TOTALS_INPUT, flat_totals, window_totals
from tillwatch.session import UTC_ZONES
from tillwatch.sinks.batches import BatchFolders, BatchSummary, glance, stamp, stream_of, summarize
from tillwatch.sinks.events import EventLog
from tillwatch.sinks.ledger import MAIN, Ledger, Written, once
from tillwatch.streaming.monitor import INTAKE


@dataclass(frozen=True)
class StreamConfig:
    """Output root, checkpoint root and the knobs of both queries.

    ``enriched_files`` merges the enriched events of a batch to that many
    files, behind a written table, so that decoding keeps its tasks; without it each
    task writes its own file. ``totals_files`` merges totals and alerts, which are
    small rows; None leaves one file per state partition. ``max_ahead`` bounds how far an
    event time may lie ahead of its record's, see ``classify_records``.

    A new checkpoint over an old root is a new stream of its ``lineage``: by default it reads its source
    anew and replaces the results before it, with ``continues`` it goes on behind them; see ``Ledger``.
    """

    output_root: str
    checkpoint_root: str
    trigger: dict[str, Any] = field(default_factory=lambda: {"processingTime": TRIGGER_INTERVAL})
    watermark_delay: str = WATERMARK_DELAY
    window_length: str = WINDOW_LENGTH
    rules: Sequence[AlertRule] = DEFAULT_RULES
    known_schema_ids: Sequence[int] | None = None
    quarantine: bool = True
    format: str = "csv"
    enriched_files: int | None = None
    totals_files: int | None = 1
    max_ahead: str | None = None
    lineage: str = MAIN
    continues: bool = False

    def ledger(self, query: str) -> Ledger:
        return Ledger(f"{self.output_root}/ledger/{query}", self.lineage, self.continues)

    @property
    def enriched(self) -> BatchFolders:
        return BatchFolders(f"{self.output_root}/enriched", self.format, hourly=True, ledger=self.ledger("enriched"))

    @property
    def events(self) -> EventLog:
        return EventLog(f"{self.output_root}/events")

    @property
    def quarantined(self) -> BatchFolders:
        # record values are bytes, which CSV cannot hold
        return BatchFolders(f"{self.output_root}/quarantine", "parquet", hourly=True, ledger=self.ledger("enriched"))

    @property
    def totals(self) -> BatchFolders:
        return BatchFolders(f"{self.output_root}/totals", self.format, ledger=self.ledger("totals"))

    @property
    def alerts(self) -> BatchFolders:
        return BatchFolders(f"{self.output_root}/alerts", self.format, ledger=self.ledger("totals"))


def _classified(records: DataFrame, config: StreamConfig) -> DataFrame:
    return classify_records(records, config.known_schema_ids, config.window_length, config.max_ahead)


def enriched_stream(records: DataFrame, config: StreamConfig) -> DataFrame:
    """Enriched events; late ones and those without a time are kept."""
    return accepted_events(_classified(records, config))


def totals_stream(records: DataFrame, config: StreamConfig) -> DataFrame:
    """Running window totals; events of a closed window are left out."""
    return _totals_of(accepted_events(_classified(records, config), TOTALS_INPUT), config)


def _totals_of(events: DataFrame, config: StreamConfig) -> DataFrame:
    """Window totals of events; how many came in, and with a time, is in the progress of each batch."""
    taken = events.observe(INTAKE, F.count("*").alias("events"), F.count("event_time").alias("timed"))
    return window_totals(with_watermark(taken, config.watermark_delay), config.window_length)


def _write_events(events: DataFrame, config: StreamConfig, batch_id: int, summary: BatchSummary) -> None:
    if config.enriched_files is None:
        config.enriched.write(events, batch_id, summary)
    else:
        config.enriched.write_gathered(events, batch_id, summary, config.enriched_files)


def _written(summary: BatchSummary, counts: dict[str, int]) -> Written:
    return Written(summary.date, summary.hour, counts)


def _counting(batch: DataFrame, *stages: str) -> tuple[DataFrame, Observation]:
    """The batch with its records, and the defects of each stage, counted by whatever runs over all of it."""
    seen = Observation()
    return batch.observe(seen, F.count("*").alias("records"), *[F.count_if(F.col("stage") == stage).alias(stage) for stage in stages]), seen


def _write_enriched(config: StreamConfig) -> Callable[[DataFrame, int], Written | None]:
    def write(batch: DataFrame, batch_id: int) -> Written | None:
        summary = glance(batch)
        if not summary.rows:
            return None
        counted, seen = _counting(batch)
        _write_events(counted, config, batch_id, summary)
        return _written(summary, seen.get)

    return write


def _write_enriched_and_quarantine(config: StreamConfig) -> Callable[[DataFrame, int], Written | None]:
    def write(batch: DataFrame, batch_id: int) -> Written | None:
        # Defects are counted while the events are written, and only a batch with any is decoded again:
        # the events of a backlog are never kept, neither in memory nor on local disks.
        summary = glance(batch)
        if not summary.rows:
            return None
        counted, seen = _counting(batch, *STAGES)
        events = keep_rows(counted, is_accepted(), ENRICHED_COLUMNS)
        _write_events(events, config, batch_id, summary)
        if any(seen.get[stage] for stage in STAGES):
            config.quarantined.write(keep_rows(batch, is_defective(), QUARANTINE_COLUMNS), batch_id, summary)
        return _written(summary, seen.get)

    return write


def _write_totals_and_alerts(config: StreamConfig) -> Callable[[DataFrame, int], Written | None]:
    def write(batch: DataFrame, batch_id: int) -> Written | None:
        # without this every action would run the stateful aggregation again
        batch.persist()
        try:
            summary = summarize(batch)
            if not summary.rows:
                return None
            config.totals.write(batch, batch_id, summary, config.totals_files)
            alerts = find_alerts(batch, config.rules)
            if not alerts.isEmpty():
                config.alerts.write(alerts, batch_id, summary, config.totals_files)
            return _written(summary, {"totals": summary.rows})
        finally:
            batch.unpersist()

    return write


def _check_zone(records: DataFrame) -> None:
    """Folder names, zone-less times and windows are those of a UTC session."""
    zone = records.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_ZONES:
        raise ValueError(f"session time zone is {zone}; set spark.sql.session.timeZone to UTC")


def start_enriched(records: DataFrame, config: StreamConfig) -> StreamingQuery:
    _check_zone(records)
    if config.quarantine:
        classified = _classified(records, config)
        # of an accepted record only the fields are kept with the batch
        stream = classified.withColumn("value", F.when(is_defective(), F.col("value"))).select(
            *ENRICHED_COLUMNS, *QUARANTINE_COLUMNS
        )
        write = _write_enriched_and_quarantine(config)
    else:
        stream = enriched_stream(records, config)
        write = _write_enriched(config)
    return (
        stamp(stream)
        .writeStream.queryName("enriched")
        .outputMode("append")
        .foreachBatch(once(config.ledger("enriched"), write, stream_of))
        .trigger(**config.trigger)
        .option("checkpointLocation", f"{config.checkpoint_root}/enriched")
        .start()
    )


def _start_totals(totals: DataFrame, config: StreamConfig, name: str) -> StreamingQuery:
    return (
        stamp(flat_totals(totals))
        .writeStream.queryName(name)
        .outputMode("update")
        .foreachBatch(once(config.ledger("totals"), _write_totals_and_alerts(config), stream_of))
        .trigger(**config.trigger)
        .option("checkpointLocation", f"{config.checkpoint_root}/{name}")
        .start()
    )


def start_totals(records: DataFrame, config: StreamConfig) -> StreamingQuery:
    _check_zone(records)
    return _start_totals(totals_stream(records, config), config, "totals")


def start_events(records: DataFrame, config: StreamConfig) -> StreamingQuery:
    """Decode records once into the event log, which any number of streams and readers take up."""
    _check_zone(records)
    rows = EventLog.rows(stamp(_classified(records, config)), config.quarantine)
    return (
        rows.writeStream.queryName("events")
        .outputMode("append")
        .format("parquet")
        .partitionBy(*EventLog.FOLDERS)
        .trigger(**config.trigger)
        .option("checkpointLocation", f"{config.checkpoint_root}/events")
        .option("path", config.events.root)
        .start()
    )


def start_event_totals(spark: SparkSession, config: StreamConfig) -> StreamingQuery:
    """The totals query over the event log instead of a topic: nothing is decoded again."""
    events = config.events.stream(spark)
    _check_zone(events)
    return _start_totals(_totals_of(events.select(*TOTALS_INPUT), config), config, "event-totals")


def start_chained(records: DataFrame, config: StreamConfig) -> tuple[StreamingQuery, StreamingQuery]:
    """Event log and totals, with each record read and decoded once. Under ``availableNow`` the log is written to its end first."""
    events = start_events(records, config)
    if "availableNow" in config.trigger:
        events.awaitTermination()
    return events, start_event_totals(records.sparkSession, config)


def start_all(records: DataFrame, config: StreamConfig) -> tuple[StreamingQuery, StreamingQuery]:
    """Both queries over one source; each reads it with its own offsets."""
    return start_enriched(records, config), start_totals(records, config)


def await_any(spark: SparkSession) -> None:
    """Wait until the first query ends; a failed one raises its error."""
    spark.streams.awaitAnyTermination()
