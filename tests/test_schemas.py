"""Records checked by the schema that their id names."""

import json

import pytest

from tillwatch.functions.wire import MAX_LEVELS
from tillwatch.operators import schemas
from tillwatch.operators.decode import decode_records
from tillwatch.operators.schemas import SCHEMA_TABLE, decode_by_schema

TABLE = [
    (1, "a", "string"),
    (1, "b", "integer"),
    (2, "x", "number"),
    (2, "y", "object"),
    (2, "z", "array"),
    (2, "w", "boolean"),
    (2**32 - 1, "any", "any"),
]


def framed(number, payload):
    text = payload if isinstance(payload, bytes) else (payload if isinstance(payload, str) else json.dumps(payload)).encode()
    return b"\x00" + number.to_bytes(4, "big") + text


def decoded(spark, values, table=TABLE):
    frame = spark.createDataFrame(list(enumerate(values)), "place int, value binary").coalesce(1)
    rows = decode_by_schema(frame, spark.createDataFrame(table, SCHEMA_TABLE)).orderBy("place").collect()
    return [(row.schema_id, row.fields, tuple(row.defect) if row.defect else None) for row in rows]


def wrong(name, kind):
    return ("schema", f"{name} is not of type {kind}")


JSON = ("json", "payload is not one JSON object")
ORDER = {"x": 1.5, "y": {"q": [1]}, "z": [1, "a"], "w": True}


def test_every_record_by_its_own_schema(spark):
    cases = [
        (framed(1, {"a": "s", "b": 3, "c": None}), (1, {"a": "s", "b": "3"}, None)),
        (framed(1, {"a": "s", "b": 3.5}), (1, None, wrong("b", "integer"))),
        (framed(1, {"a": None, "b": 3}), (1, None, wrong("a", "string"))),
        (framed(1, {"b": "3"}), (1, None, wrong("a", "string"))),
        (framed(1, ORDER), (1, None, wrong("a", "string"))),
        (framed(2, ORDER), (2, {"x": "1.5", "y": '{"q":[1]}', "z": '[1,"a"]', "w": "true"}, None)),
        (framed(2, ORDER | {"x": 7, "y": {}, "z": []}), (2, {"x": "7", "y": "{}", "z": "[]", "w": "true"}, None)),
        (framed(2, ORDER | {"w": "true"}), (2, None, wrong("w", "boolean"))),
        (framed(2, ORDER | {"x": "1"}), (2, None, wrong("x", "number"))),
        (framed(2, ORDER | {"y": []}), (2, None, wrong("y", "object"))),
        (framed(2, ORDER | {"z": {}}), (2, None, wrong("z", "array"))),
        (framed(2**32 - 1, {"any": [0]}), (2**32 - 1, {"any": "[0]"}, None)),
        (framed(2**32 - 1, {"any": None}), (2**32 - 1, None, wrong("any", "any"))),
        (framed(3, {}), (3, None, ("frame", "unknown schema id"))),
        (framed(1, "[]"), (1, None, JSON)),
        (framed(1, '{"a":"s","b":1} x'), (1, None, JSON)),
        (framed(1, '{"a":"s","b":1}] x'), (1, None, JSON)),
        (framed(1, '{"a":"s","b":1},{"a":"s","b":1}'), (1, None, JSON)),
        (framed(1, '{"a":"s","b":1'), (1, None, JSON)),
        (framed(1, '{"a":"first","a":5,"b":1}'), (1, {"a": "first", "b": "1"}, None)),
        (framed(1, b"\xff"), (1, None, ("utf8", "payload is not UTF-8"))),
        (framed(2, '{"y":' + "[" * 2000 + "]" * 2000 + "}"), (2, None, ("json", f"payload is over the limit of {MAX_LEVELS} levels, or not one JSON object"))),
        (None, (None, None, ("frame", "value is null"))),
        (b"x", (None, None, ("frame", "no frame header"))),
    ]
    assert decoded(spark, [value for value, _ in cases]) == [found for _, found in cases]


def test_the_fixed_schema_as_a_table(spark):
    """With the event's three strings as the schema of id 1, both decoders agree on every record."""
    event = {"timestamp": "t", "level": "l", "message": "m"}
    values = [framed(1, event), framed(1, event | {"more": [1]}), framed(1, event | {"level": 5}), framed(1, "{}"), framed(1, "[1]"), b"", None, framed(1, b"\xfe")]
    by_table = decoded(spark, values, [(1, name, "string") for name in event])
    frame = spark.createDataFrame(list(enumerate(values)), "place int, value binary").coalesce(1)
    fixed = decode_records(frame).orderBy("place").collect()
    assert [(row.event.asDict() if row.event else None, row.defect.stage if row.defect else None) for row in fixed] == [
        (fields, defect[0] if defect else None) for _, fields, defect in by_table
    ]


def test_many_schemas_are_joined_by_a_shuffle(spark, monkeypatch, capsys):
    frame = spark.createDataFrame([(framed(1, {"a": "s", "b": 3}),)], "value binary")
    table = spark.createDataFrame(TABLE, SCHEMA_TABLE)
    decode_by_schema(frame, table).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
    monkeypatch.setattr(schemas, "MOST_SENT", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decode_by_schema(frame, table)
        found.explain()
        assert "SortMergeJoin" in capsys.readouterr().out
        assert found.first().fields == {"a": "s", "b": "3"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_payload_is_parsed_once(spark, capsys):
    frame = spark.createDataFrame([(framed(1, "{}"),)], "value binary")
    decode_by_schema(frame, spark.createDataFrame(TABLE, SCHEMA_TABLE)).explain()
    assert capsys.readouterr().out.count("from_json(ArrayType") == 1


@pytest.mark.parametrize("row", [(1, "a", "text"), (1, "a", None), (None, "a", "string"), (1, None, "string"), (1, "b", "number")])
def test_schemas_that_are_none(spark, row):
    with pytest.raises(ValueError, match="not a schema field"):
        schemas.checked_schemas(spark.createDataFrame([*TABLE, row], SCHEMA_TABLE))
