"""Ledger of streams and batches: lineages, epochs, visibility, merged hours."""

import shutil
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from records import Topic, payment

from tillwatch.contract import ALERT_SCHEMA, ENRICHED_SCHEMA, TOTALS_SCHEMA
from tillwatch.operators.totals import latest_totals
from tillwatch.sinks.batches import BatchFolders, glance, stamp
from tillwatch.sinks.events import EventLog
from tillwatch.sinks.ledger import ALL, Ledger
from tillwatch.sources.files import stream_records
from tillwatch.streaming import jobs
from tillwatch.streaming.jobs import StreamConfig, start_chained, start_enriched, start_totals


def text(minute: int, second: int) -> str:
    return f"2025-05-01T12:{minute:02}:{second:02}+00:00"


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def config(tmp_path):
    return StreamConfig(f"{tmp_path}/out", f"{tmp_path}/checkpoints", trigger={"availableNow": True})


def run(spark, topic, config, start=start_totals):
    start(stream_records(spark, str(topic.path), max_files_per_trigger=1), config).awaitTermination()


def counts(spark, config, **read):
    return {row.start.minute: row.event_count for row in latest_totals(config.totals.read(spark, TOTALS_SCHEMA, **read)).collect()}


def fresh(config, tmp_path, name, **changes):
    return replace(config, checkpoint_root=f"{tmp_path}/{name}", **changes)


def forget_commits(config, name, last=1):
    """As if the stream was lost after its last batches and before Spark noted them."""
    folder = Path(config.checkpoint_root) / name / "commits"
    for batch in sorted((path for path in folder.iterdir() if path.name.isdigit()), key=lambda path: int(path.name))[-last:]:
        batch.unlink()
        (folder / f".{batch.name}.crc").unlink(missing_ok=True)


def test_epochs_of_two_lineages(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for stream, lineage, continues in [("a", "main", False), ("x", "other", True), ("b", "main", True), ("c", "main", False), ("a", "main", False), ("d", "main", True)]:
        Ledger(path, lineage, continues).enter(spark, stream)
    ledger = Ledger(path)
    assert ledger.epochs(spark).by_epoch == {1: ("a", "b"), 2: ("c", "d")}
    assert ledger.epochs(spark, "other").by_epoch == {1: ("x",)}
    rows = spark.createDataFrame([(s,) for s in ["a", "b", "c", "d", "x", "unlisted"]], "stream string")
    taken = lambda epoch: {row.stream for row in rows.where(ledger.epochs(spark).holds(epoch)).collect()}
    assert [taken(epoch) for epoch in (None, 1, 0, 7, ALL)] == [{"c", "d"}, {"a", "b"}, {"unlisted"}, set(), {"a", "b", "c", "d", "unlisted"}]


def test_a_new_checkpoint_replaces_or_continues(spark, topic, config, tmp_path):
    topic.add(payment(text(0, 1)), payment(text(1, 1)))
    for second in (2, 3, 4):
        topic.add(payment(text(1, second)))
    run(spark, topic, fresh(config, tmp_path, "first"))
    assert counts(spark, config) == {0: 1, 1: 4}
    # the topic no longer holds all records; batch ids of the new stream are lower
    shorter = Topic(spark, tmp_path / "shorter")
    shorter.add(payment(text(1, 1)), payment(text(1, 2)))
    run(spark, shorter, fresh(config, tmp_path, "second"))
    assert counts(spark, config) == {1: 2}
    assert counts(spark, config, epoch=1) == {0: 1, 1: 4}
    further = Topic(spark, tmp_path / "further")
    further.add(payment(text(1, 9)), payment(text(2, 1)))
    run(spark, further, fresh(config, tmp_path, "third", continues=True))
    assert counts(spark, config) == {1: 3, 2: 1}
    # another lineage below the same root
    other = fresh(config, tmp_path, "other", lineage="other")
    run(spark, shorter, other)
    assert counts(spark, config) == {1: 3, 2: 1} and counts(spark, other) == {1: 2}


def test_totals_and_alerts_of_a_batch_are_seen_together(spark, topic, config, monkeypatch):
    topic.add(*[payment(text(0, s), failed=True) for s in range(12)])
    run(spark, topic, config)
    topic.add(*[payment(text(0, s), failed=True) for s in range(12, 20)])
    seen = []

    def between(totals, rules):
        """What a reader finds after the totals are written and before the alerts are."""
        seen.append((counts(spark, config), config.alerts.read(spark, ALERT_SCHEMA).count()))
        raise RuntimeError("lost between the writes")

    monkeypatch.setattr(jobs, "find_alerts", between)
    with pytest.raises(StreamingQueryException):
        run(spark, topic, config)
    monkeypatch.undo()
    assert seen == [({0: 12}, 1)]
    assert len(list(Path(config.output_root).glob("totals/*/*/batch_id=*"))) > 1
    assert counts(spark, config) == {0: 12}
    run(spark, topic, config)
    assert counts(spark, config) == {0: 20} and config.alerts.read(spark, ALERT_SCHEMA).count() == 2


def test_a_replayed_batch_leaves_no_hole(spark, topic, config):
    """Its folders are not touched, and the state goes on from it."""
    topic.add(payment(text(0, 1), 1.0))
    topic.add(payment(text(0, 2), 2.0))
    run(spark, topic, config)
    before = {path: path.stat().st_mtime_ns for path in Path(config.output_root).rglob("part-*")}
    forget_commits(config, "totals")
    topic.add(payment(text(0, 3), 4.0))
    run(spark, topic, config)
    after = {path: path.stat().st_mtime_ns for path in Path(config.output_root).rglob("part-*")}
    assert before.items() <= after.items()
    (last,) = latest_totals(config.totals.read(spark, TOTALS_SCHEMA)).collect()
    assert (last.event_count, last.total_amount) == (3, 7.0)


def test_what_was_written_before_there_was_a_ledger(spark, tmp_path):
    folders = BatchFolders(str(tmp_path / "out"), ledger=Ledger(str(tmp_path / "ledger")))
    at = F.lit(datetime(2025, 6, 7, 8, 0, tzinfo=timezone.utc))
    batch = stamp(spark.createDataFrame([(datetime(2025, 5, 1), datetime(2025, 5, 2), "Payment", True, 2, 3.0)], TOTALS_SCHEMA), at)
    folders.write(batch, 1, glance(batch))
    assert folders.read(spark, TOTALS_SCHEMA).count() == 1
    folders.ledger.enter(spark, "new")
    assert folders.read(spark, TOTALS_SCHEMA).count() == 0
    assert folders.read(spark, TOTALS_SCHEMA, epoch=0).count() == 1


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_merged_hours_hold_the_same_rows(spark, topic, config, format):
    config = replace(config, format=format)
    for second in range(6):
        topic.add(payment(text(0, second), order=f"o{second}"), payment("garbage", order=f"timeless{second}"))
    run(spark, topic, config, start_enriched)
    rows = lambda: sorted(map(repr, config.enriched.read(spark, ENRICHED_SCHEMA).collect()))
    before = rows()
    assert config.enriched.merge_closed_hours(spark, ENRICHED_SCHEMA, before="2000-01-01 00") == 0
    assert config.enriched.merge_closed_hours(spark, ENRICHED_SCHEMA, before="9999-12-31 23") == 6
    assert config.enriched.merge_closed_hours(spark, ENRICHED_SCHEMA, before="9999-12-31 23") == 0
    assert rows() == before and len(before) == 12
    assert config.enriched.remove_merged(spark) == 6
    assert rows() == before
    assert not list(Path(config.output_root).glob("enriched/**/part-*"))
    assert len(list(Path(config.output_root).glob("enriched-merged/**/part-*"))) == 1
    # a replay of the last, merged, batch and a new one behind it
    forget_commits(config, "enriched")
    topic.add(payment(text(0, 30), order="new"))
    run(spark, topic, config, start_enriched)
    assert len(rows()) == 13 and set(before) < set(rows())


def test_a_merge_that_is_lost_before_its_last_write_changes_nothing(spark, topic, config):
    topic.add(payment(text(0, 1)))
    run(spark, topic, config, start_enriched)
    config.enriched.merge_closed_hours(spark, ENRICHED_SCHEMA, before="9999-12-31 23")
    shutil.rmtree(f"{config.output_root}/enriched-merges")
    assert config.enriched.read(spark, ENRICHED_SCHEMA).count() == 1
    assert config.enriched.merge_closed_hours(spark, ENRICHED_SCHEMA, before="9999-12-31 23") == 1
    assert config.enriched.read(spark, ENRICHED_SCHEMA).count() == 1


def test_only_hourly_folders_with_a_ledger_are_merged(spark, config, tmp_path):
    for folders in (config.totals, BatchFolders(str(tmp_path), hourly=True)):
        with pytest.raises(ValueError, match="hourly"):
            folders.merge_closed_hours(spark, TOTALS_SCHEMA, "2025-01-01 00")


@pytest.mark.parametrize("lost", ["events", "event-totals"])
def test_chained_totals_count_replayed_batches_once(spark, topic, config, lost):
    chained = lambda: [query.awaitTermination() for query in start_chained(stream_records(spark, str(topic.path), 1), config)]
    topic.add(payment(text(0, 1), 1.0), b"no record", payment("garbage"))
    topic.add(payment(text(0, 2), 2.0))
    chained()
    forget_commits(config, lost)
    topic.add(payment(text(0, 3), 4.0))
    chained()
    (last,) = latest_totals(config.totals.read(spark, TOTALS_SCHEMA)).collect()
    assert (last.event_count, last.total_amount) == (3, 7.0)
    assert config.events.enriched(spark).count() == 4
    assert sorted(row.stage for row in config.events.quarantined(spark).collect()) == ["frame", "time"]


def test_totals_over_the_event_log_decode_nothing(spark, topic, config, capsys):
    topic.add(payment(text(0, 1)))
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for query in start_chained(stream_records(spark, str(topic.path)), config):
            query.awaitTermination()
            query.explain()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    plan = capsys.readouterr().out
    assert plan.count("from_json(ArrayType") == 1 and "ReadSchema: struct<event_time:timestamp,type:string,is_failed:boolean,amount:double>" in plan


def test_both_chained_queries_run_at_once(spark, topic, config):
    config = replace(config, trigger={"processingTime": "1 second"}, quarantine=False)
    topic.add(payment(text(0, 1)), b"no record")
    events, totals = start_chained(stream_records(spark, str(topic.path)), config)
    try:
        for second in (2, 3):
            events.processAllAvailable()
            totals.processAllAvailable()
            topic.add(payment(text(0, second)))
        events.processAllAvailable()
        totals.processAllAvailable()
    finally:
        events.stop()
        totals.stop()
    assert counts(spark, config) == {0: 3}
    assert config.events.quarantined(spark).isEmpty() and set(EventLog.FOLDERS) <= set(EventLog.SCHEMA.names)
