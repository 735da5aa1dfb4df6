"""Accepted events and the quarantine."""

from pyspark.sql import functions as F
from records import payment, records, wire_value

from tillwatch.contract import ENRICHED_SCHEMA, QUARANTINE_SCHEMA
from tillwatch.operators.enrich import accepted_events, classify_records, keep_rows, quarantined_records

TIME = "2025-05-01T12:00:00+00:00"


def test_routing(spark):
    batch = records(
        spark,
        payment(TIME),
        None,
        payment("garbage"),
        wire_value(TIME, "short"),
        wire_value("garbage", "short"),
    )
    classified = classify_records(batch)
    accepted = accepted_events(classified).collect()
    assert [(row.event_time is None, row.type) for row in accepted] == [(False, "Payment"), (True, "Payment")]
    rejected = {row.offset: (row.stage, row.error) for row in quarantined_records(classified).collect()}
    assert rejected == {
        1: ("frame", "value is null"),
        2: ("time", "timestamp is not a time"),
        3: ("parse", "message is too short"),
        4: ("parse", "message is too short"),
    }


def test_schemas(spark):
    classified = classify_records(records(spark, payment(TIME)))
    for found, schema in ((accepted_events(classified), ENRICHED_SCHEMA), (quarantined_records(classified), QUARANTINE_SCHEMA)):
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in schema]


def test_keep_rows_is_a_filter(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "i int, s string")
    for condition in ("s = 'a'", "s is null", "i > 5", "true"):
        kept = keep_rows(df, F.expr(condition), ("s", "i"))
        assert kept.collect() == df.where(condition).select("s", "i").collect()
