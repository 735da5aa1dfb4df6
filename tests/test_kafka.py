"""Options of the message broker. Its connector is not on the class path here."""

import pytest
from pyspark.errors import PySparkException
from records import payment, records

from tillwatch.sources.kafka import KafkaSource, KafkaTarget

SERVERS = "broker1:9092,broker2:9092"


def test_source_defaults():
    assert KafkaSource(SERVERS).options() == {
        "kafka.bootstrap.servers": SERVERS,
        "subscribe": "payment",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "minPartitions": "64",
        "maxOffsetsPerTrigger": "10000000",
    }


def test_source_knobs():
    source = KafkaSource(
        "h:1", "other", "latest", False, min_partitions=64, max_offsets_per_trigger=10**6, extra={"includeHeaders": "true"}
    )
    assert source.options() == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "other",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
        "maxOffsetsPerTrigger": "1000000",
        "includeHeaders": "true",
    }


def test_target(spark):
    target = KafkaTarget(SERVERS, spread_over=3)
    assert target.options() == {"kafka.bootstrap.servers": SERVERS, "topic": "payment"}
    rows = target.rows(records(spark, *[payment("2025-05-01", order=f"o{i}") for i in range(60)]))
    assert rows.dtypes == [("key", "binary"), ("value", "binary"), ("partition", "int")]
    assert {row.partition for row in rows.collect()} == {0, 1, 2}
    assert KafkaTarget(SERVERS).spread_over == 3
    assert KafkaTarget(SERVERS, spread_over=None).rows(rows).columns == ["key", "value"]


def test_the_connector_is_asked_for(spark):
    with pytest.raises(PySparkException, match="(?i)kafka"):
        KafkaSource(SERVERS).stream(spark)
    with pytest.raises(PySparkException, match="(?i)kafka"):
        KafkaSource(SERVERS).batch(spark)
    with pytest.raises(PySparkException, match="(?i)kafka"):
        KafkaTarget(SERVERS).batch_writer(records(spark, payment("2025-05-01"))).save()


def test_stream_writer(spark, tmp_path):
    from records import Topic

    from tillwatch.sources.files import stream_records

    topic = Topic(spark, tmp_path / "topic")
    topic.add(payment("2025-05-01"))
    writer = KafkaTarget(SERVERS).stream_writer(stream_records(spark, str(topic.path)), f"{tmp_path}/checkpoint")
    with pytest.raises(PySparkException, match="(?i)kafka"):
        writer.start()


def test_command_line_options(spark):
    from tillwatch.streaming import produce, run

    base = ["--bootstrap-servers", "h:1", "--output", "o", "--checkpoint", "c"]
    defaults = run.parser().parse_args(base)
    assert (defaults.fail_on_data_loss, defaults.min_partitions, defaults.max_offsets_per_trigger) == (True, 64, 10_000_000)
    assert defaults.shuffle_partitions == 8
    args = run.parser().parse_args([*base, "--no-fail-on-data-loss", "--source-option", "kafka.security.protocol=SSL"])
    assert not args.fail_on_data_loss and dict(args.source_option) == {"kafka.security.protocol": "SSL"}
    with pytest.raises(SystemExit):
        run.parser().parse_args([*base, "--source-option", "nonsense"])
    to = ["--tables", "t", "--bootstrap-servers", "h:1", "--target-option", "kafka.acks=all"]
    target = produce.target_of(produce.parser().parse_args(to))
    assert target.spread_over == 3 and target.options()["kafka.acks"] == "all"
    assert produce.target_of(produce.parser().parse_args([*to, "--by-key"])).spread_over is None
