"""Registered queries that run the streaming jobs over the orders table.

Each runs its stream until the input is used up and returns what the sinks
then hold.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tillwatch.contract import ALERT_SCHEMA, ENRICHED_SCHEMA, QUARANTINE_SCHEMA, TOTALS_SCHEMA
from tillwatch.operators.render import order_records
from tillwatch.operators.totals import dropped_events, latest_totals
from tillwatch.plans.batch import presentable
from tillwatch.plans.variants import faulty_records
from tillwatch.session import work_dir
from tillwatch.sources.files import append_records, stream_records
from tillwatch.sources.tables import read_orders, stream_orders
from tillwatch.streaming.jobs import StreamConfig, await_any, start_all, start_chained, start_enriched, start_events, start_totals
from tillwatch.streaming.monitor import BatchProgress, batch_progress, late_events


def one_pass_config(spark: SparkSession, label: str) -> StreamConfig:
    root = work_dir(spark, label)
    return StreamConfig(f"{root}/output", f"{root}/checkpoint", trigger={"availableNow": True})


def stream_enriched_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = one_pass_config(spark, "enriched")
    start_enriched(order_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    return presentable(config.enriched.read(spark, ENRICHED_SCHEMA).select(*ENRICHED_SCHEMA.names))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = one_pass_config(spark, "quarantine")
    start_enriched(faulty_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    records = config.quarantined.read(spark, QUARANTINE_SCHEMA)
    return records.select(F.col("offset").alias("order_key"), "topic", "partition", "stage", "error")


def stream_minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = one_pass_config(spark, "totals")
    start_totals(order_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    return presentable(latest_totals(config.totals.read(spark, TOTALS_SCHEMA)))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = one_pass_config(spark, "alerts")
    start_totals(order_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    return presentable(config.alerts.read(spark, ALERT_SCHEMA, missing_ok=True).select(*ALERT_SCHEMA.names))


def _arrive_twice(spark: SparkSession, sf_dir: str, start, config: StreamConfig) -> None:
    """All orders arrive, the stream stops, all arrive again and it resumes."""
    topic = f"{config.output_root}/topic"
    for _ in range(2):
        append_records(order_records(read_orders(spark, sf_dir)), topic)
        start(stream_records(spark, topic), config).awaitTermination()


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals do not count an event whose window the watermark has passed."""
    config = one_pass_config(spark, "late-totals")
    _arrive_twice(spark, sf_dir, start_totals, config)
    return presentable(latest_totals(config.totals.read(spark, TOTALS_SCHEMA)))


def stream_late_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched events are kept however late they come."""
    config = one_pass_config(spark, "late-enriched")
    _arrive_twice(spark, sf_dir, start_enriched, config)
    return presentable(config.enriched.read(spark, ENRICHED_SCHEMA).select(*ENRICHED_SCHEMA.names))


# Parts in which all orders arrive, in the order of their keys and so of their times.
ARRIVALS = 3


def _parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Records of all orders, a third after the other."""
    orders = read_orders(spark, sf_dir)
    (above,) = orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)) + 1).first()
    part = F.floor(F.col("o_orderkey") * ARRIVALS / F.lit(above))
    return [order_records(orders.where(part == arrival)) for arrival in range(ARRIVALS)]


def _arrive(parts: list[DataFrame], start, config: StreamConfig, topic: str) -> None:
    """Parts arrive one after the other; the stream stops between them and resumes."""
    for part in parts:
        append_records(part, topic)
        start(stream_records(part.sparkSession, topic), config).awaitTermination()


def _arrive_in_parts(spark: SparkSession, sf_dir: str, config: StreamConfig) -> None:
    _arrive(_parts(spark, sf_dir), start_totals, config, f"{config.output_root}/topic")


def _arrival_of(rows: DataFrame) -> DataFrame:
    """``arrival`` in place of the batch id: batches that only move the watermark have ids as well."""
    ids = rows.select("batch_id").distinct()
    # one row per micro-batch that wrote anything
    numbered = ids.select("batch_id", (F.row_number().over(Window.orderBy("batch_id")) - 1).alias("arrival"))
    return rows.join(numbered, "batch_id").drop("batch_id", "proc_date", "stream")


def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of totals: a group is written again, with its running total, by each batch that adds to it."""
    config = one_pass_config(spark, "running")
    _arrive_in_parts(spark, sf_dir, config)
    return presentable(_arrival_of(config.totals.read(spark, TOTALS_SCHEMA)))


def stream_repeated_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An open window alerts again with each batch that adds to it."""
    config = one_pass_config(spark, "repeated")
    _arrive_in_parts(spark, sf_dir, config)
    changes = _arrival_of(config.totals.read(spark, TOTALS_SCHEMA)).select("start", "end", "type", "is_failed", "event_count", "arrival")
    alerts = config.alerts.read(spark, ALERT_SCHEMA, missing_ok=True)
    # the count of a group grows with each of its batches, so it tells which one alerted
    return presentable(alerts.select(*ALERT_SCHEMA.names).join(changes, ["start", "end", "type", "is_failed", "event_count"]))


def stream_both_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both queries over one source: events of the one and totals of the other, by type and outcome."""
    config = one_pass_config(spark, "both")
    for query in start_all(order_records(stream_orders(spark, sf_dir)), config):
        query.awaitTermination()
    keys = ["type", "is_failed"]
    events = config.enriched.read(spark, ENRICHED_SCHEMA).groupBy(*keys).agg(F.count("*").alias("enriched_events"))
    totals = latest_totals(config.totals.read(spark, TOTALS_SCHEMA))
    counted = totals.groupBy(*keys).agg(F.sum("event_count").alias("counted_events"), F.sum("total_amount").alias("total_amount"))
    return presentable(events.join(counted, keys, "full"))


def stream_empty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches without records between batches with all of them write nothing: batches that wrote, and their events."""
    config = one_pass_config(spark, "empty")
    topic = f"{config.output_root}/topic"
    records = order_records(read_orders(spark, sf_dir))
    for part in (records.limit(0), records, records.limit(0), records, records.limit(0)):
        append_records(part, topic)
        start_enriched(stream_records(spark, topic), config).awaitTermination()
    written = config.enriched.read(spark, ENRICHED_SCHEMA)
    return written.agg(F.count_distinct("batch_id").alias("batches"), F.count("*").alias("events"))


def stream_merged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tasks decode, two files are written: files, and events in them."""
    config = replace(one_pass_config(spark, "merged"), enriched_files=2)
    start_enriched(order_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    # without the ledger: a file name is only known of rows that are joined with nothing
    written = replace(config.enriched, ledger=None).read(spark, ENRICHED_SCHEMA)
    return written.select(F.input_file_name().alias("file")).agg(F.count_distinct("file").alias("files"), F.count("*").alias("events"))


def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched stream under its ordinary trigger, stopped once all is processed."""
    config = replace(one_pass_config(spark, "interval"), trigger={"processingTime": "1 second"})
    query = start_enriched(order_records(stream_orders(spark, sf_dir)), config)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return presentable(config.enriched.read(spark, ENRICHED_SCHEMA).select(*ENRICHED_SCHEMA.names))


def stream_dropped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events came too late for the totals, by window."""
    config = one_pass_config(spark, "dropped")
    _arrive_twice(spark, sf_dir, start_totals, config)
    _arrive_twice(spark, sf_dir, start_enriched, replace(config, output_root=f"{config.output_root}/kept"))
    events = replace(config, output_root=f"{config.output_root}/kept").enriched.read(spark, ENRICHED_SCHEMA)
    return presentable(dropped_events(events, latest_totals(config.totals.read(spark, TOTALS_SCHEMA))))


def restarted_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new checkpoint over an old root reads all orders anew.

    Its totals replace the old ones, which count most orders twice and whose batch ids run higher.
    """
    config = one_pass_config(spark, "restarted")
    _arrive_twice(spark, sf_dir, start_totals, config)
    again = replace(config, checkpoint_root=f"{config.checkpoint_root}-new")
    start_totals(order_records(stream_orders(spark, sf_dir)), again).awaitTermination()
    return presentable(latest_totals(again.totals.read(spark, TOTALS_SCHEMA)))


def continued_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new checkpoint goes on behind the records of the old one: their totals add up, also those of a window that both have a part of."""
    config = one_pass_config(spark, "continued")
    *first, last = _parts(spark, sf_dir)
    _arrive(first, start_totals, config, f"{config.output_root}/topic")
    further = replace(config, checkpoint_root=f"{config.checkpoint_root}-new", continues=True)
    _arrive([last], start_totals, further, f"{config.output_root}/topic-new")
    return presentable(latest_totals(further.totals.read(spark, TOTALS_SCHEMA)))


def stream_chained_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the event log, which decodes all records once and is stopped and resumed between its parts, like the totals."""
    config = one_pass_config(spark, "chained")

    def start(records: DataFrame, config: StreamConfig):
        return start_chained(records, config)[1]

    _arrive(_parts(spark, sf_dir), start, config, f"{config.output_root}/topic")
    return presentable(latest_totals(config.totals.read(spark, TOTALS_SCHEMA)))


def stream_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the event log when most records have a defect."""
    config = one_pass_config(spark, "event-log")
    start_events(faulty_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    return presentable(config.events.enriched(spark).select(*ENRICHED_SCHEMA.names))


def stream_event_log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective records of the event log."""
    config = one_pass_config(spark, "event-log-quarantine")
    start_events(faulty_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    return config.events.quarantined(spark).select(F.col("offset").alias("order_key"), "topic", "partition", "stage", "error")


def merged_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches are merged and their own folders removed before a third one comes: all events, from both kinds of folders."""
    config = one_pass_config(spark, "merged-hours")
    *first, last = _parts(spark, sf_dir)
    topic = f"{config.output_root}/topic"
    _arrive(first, start_enriched, config, topic)
    config.enriched.merge_closed_hours(spark, ENRICHED_SCHEMA, before="9999-12-31 23")
    config.enriched.remove_merged(spark)
    _arrive([last], start_enriched, config, topic)
    return presentable(config.enriched.read(spark, ENRICHED_SCHEMA).select(*ENRICHED_SCHEMA.names))


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of a stream counted while they were written: records, and defects by stage."""
    config = one_pass_config(spark, "counts")
    start_enriched(faulty_records(stream_orders(spark, sf_dir)), config).awaitTermination()
    counts = config.ledger("enriched").batches(spark).select(F.explode("counts").alias("counted", "n"))
    return counts.groupBy("counted").agg(F.sum("n").alias("n"))


def awaited_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two running queries one fails behind its records; the error reaches the caller that waits for both, and says how many there were."""
    config = replace(one_pass_config(spark, "failure"), trigger={"processingTime": "1 second"})
    records = order_records(stream_orders(spark, sf_dir))

    def fail(batch: DataFrame, batch_id: int) -> None:
        raise RuntimeError(f"failed behind {batch.count()} records")

    spark.streams.resetTerminated()
    totals = start_totals(records, config)
    records.writeStream.queryName("failing").foreachBatch(fail).option("checkpointLocation", f"{config.checkpoint_root}/failing").start()
    try:
        await_any(spark)
    except StreamingQueryException as error:
        (behind,) = re.findall(r"failed behind (\d+) records", str(error))[:1]
        running = totals.isActive
    finally:
        totals.stop()
        spark.streams.resetTerminated()
    return spark.createDataFrame([("failing", int(behind), running)], "query string, records long, other_runs boolean")


def stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and late events of each batch of the totals, from its progress: all orders arrive twice."""
    config = one_pass_config(spark, "late-counts")
    listener = BatchProgress(spark, f"{config.output_root}/progress")
    spark.streams.addListener(listener)

    def start(records: DataFrame, config: StreamConfig) -> StreamingQuery:
        query = start_totals(records, config)
        query.awaitTermination()
        listener.wait_for(query)
        return query

    try:
        _arrive_twice(spark, sf_dir, start, config)
    finally:
        spark.streams.removeListener(listener)
    found = late_events(config.totals.read(spark, TOTALS_SCHEMA), batch_progress(spark, listener.path))
    return _arrival_of(found.select("batch_id", "records", "timed", "late"))
