"""Framing, strict JSON and the reported defects."""

import json

import pytest
from pyspark.sql import functions as F

from tillwatch.operators.decode import decode_records

GOOD = {"timestamp": "2025-05-01T12:00:00+00:00", "level": "INFO", "message": "hello"}
GOOD_TEXT = json.dumps(GOOD)


def framed(text, schema_id=7):
    payload = text if isinstance(text, bytes) else text.encode()
    return b"\x00" + schema_id.to_bytes(4, "big") + payload


def decode(spark, *values, **options):
    records = spark.createDataFrame([(i, value) for i, value in enumerate(values)], "i int, value binary")
    rows = decode_records(records, **options).orderBy("i").collect()
    assert [row.i for row in rows] == list(range(len(values)))
    return rows


@pytest.mark.parametrize(
    "text",
    [
        GOOD_TEXT,
        f" \n{GOOD_TEXT}\t ",
        GOOD_TEXT.replace("}", ', "extra": [1, {"level": 2}], "more": null}'),
        '{"nested": {"timestamp": 5}, ' + GOOD_TEXT[1:],
        # a repeated key: the last one counts
        '{"level": 5, ' + GOOD_TEXT[1:],
        '{"long": ' + "1" * 5000 + ", " + GOOD_TEXT[1:],
        '{"deep": ' + "[" * 900 + "]" * 900 + ", " + GOOD_TEXT[1:],
    ],
)
def test_accepted_payloads(spark, text):
    (row,) = decode(spark, framed(text))
    assert row.defect is None
    assert row.event.asDict() == GOOD
    assert row.schema_id == 7


@pytest.mark.parametrize("message", [pytest.param("a b " * 6_000_000, id="long"), "list [1] and ]", 'quote " and \\ and }', "café  ", "null", "5", "", "true", "{}"])
def test_any_message_text_comes_back(spark, message):
    (row,) = decode(spark, framed(json.dumps(GOOD | {"message": message})))
    assert row.defect is None
    assert row.event.message == message


@pytest.mark.parametrize(
    ("value", "stage", "error"),
    [
        (None, "frame", "value is null"),
        (b"", "frame", "no frame header"),
        (b"\x00", "frame", "no frame header"),
        (b"\x00\x00\x00\x00\x01", "frame", "no frame header"),
        (GOOD_TEXT.encode(), "frame", "no frame header"),
        (b"\x01" + framed(GOOD_TEXT)[1:], "frame", "no frame header"),
        (framed(GOOD_TEXT.encode() + b"\xff"), "utf8", "payload is not UTF-8"),
        (framed("{bad"), "json", "payload is not one JSON object"),
        (framed(" "), "json", "payload is not one JSON object"),
        (framed("null"), "json", "payload is not one JSON object"),
        (framed('"text"'), "json", "payload is not one JSON object"),
        (framed(f"[{GOOD_TEXT}]"), "json", "payload is not one JSON object"),
        (framed(GOOD_TEXT + " rest"), "json", "payload is not one JSON object"),
        (framed(GOOD_TEXT + "] rest"), "json", "payload is not one JSON object"),
        (framed(GOOD_TEXT + "],["), "json", "payload is not one JSON object"),
        (framed(GOOD_TEXT + "} rest"), "json", "payload is not one JSON object"),
        (framed(f"{GOOD_TEXT},{GOOD_TEXT}"), "json", "payload is not one JSON object"),
        (framed(GOOD_TEXT.replace('"', "'")), "json", "payload is not one JSON object"),
        (framed(GOOD_TEXT.replace("hello", "tab\there")), "json", "payload is not one JSON object"),
        (framed("{}"), "schema", "timestamp is not a string"),
        (framed(json.dumps(GOOD | {"timestamp": 5})), "schema", "timestamp is not a string"),
        (framed(json.dumps(GOOD | {"timestamp": {"a": 1}})), "schema", "timestamp is not a string"),
        (framed(json.dumps(GOOD | {"level": None})), "schema", "level is not a string"),
        (framed(json.dumps(GOOD | {"level": True})), "schema", "level is not a string"),
        (framed(json.dumps({"timestamp": "t", "level": "INFO"})), "schema", "message is not a string"),
        (framed(json.dumps(GOOD | {"message": ["a"]})), "schema", "message is not a string"),
        (framed(json.dumps({"Timestamp": "t", "level": "l", "message": "m"})), "schema", "timestamp is not a string"),
    ],
)
def test_defects(spark, value, stage, error):
    (row,) = decode(spark, value)
    assert (row.defect.stage, row.defect.error) == (stage, error)
    assert row.event is None


def test_schema_id_is_unsigned_and_can_be_checked(spark):
    rows = decode(spark, framed(GOOD_TEXT, 2**32 - 1), framed(GOOD_TEXT, 9), known_schema_ids=[9])
    assert [row.schema_id for row in rows] == [2**32 - 1, 9]
    assert rows[0].defect.error == "unknown schema id" and rows[0].event is None
    assert rows[1].defect is None


def test_one_bad_record_leaves_the_others_alone(spark):
    rows = decode(spark, framed(GOOD_TEXT), framed("{bad"), None, framed(GOOD_TEXT))
    assert [row.defect is None for row in rows] == [True, False, False, True]


def test_no_ansi_error_on_any_input(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    values = [bytes([byte]) * length for byte in (0, 1, 0x5B, 0x7B, 0xFF) for length in range(9)]
    assert all(row.defect is not None for row in decode(spark, *values))


def test_input_columns_stay(spark):
    records = spark.createDataFrame([(framed(GOOD_TEXT), "payment")], "value binary, topic string")
    assert decode_records(records).columns == ["value", "topic", "schema_id", "event", "defect"]
    assert decode_records(records).select(F.col("event.level")).first()[0] == "INFO"


def test_limits_are_named(spark):
    """A payload that nests too deep is rejected for that, and does not end the query."""
    deep = b'{"extra":' + b"[" * 1100 + b"]" * 1100 + b',"timestamp":"t","level":"l","message":"m"}'
    from records import records as wire_records

    rows = decode_records(wire_records(spark, b"\x00\x00\x00\x00\x01" + deep, b"\x00\x00\x00\x00\x01{bad")).orderBy("offset").collect()
    assert [row.defect.error for row in rows] == [
        "payload is over the limit of 1000 levels, or not one JSON object",
        "payload is not one JSON object",
    ]
