"""Strictness on generated input, against Python's own JSON and number readers."""

import json
import math
from datetime import datetime, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwatch.functions.event_time import parse_event_time, render_event_time
from tillwatch.functions.text import amount_text, amount_value
from tillwatch.operators.decode import decode_records

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

plain = st.text(st.characters(exclude_categories=["Cs"]), max_size=8)
value = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-(10**6), 10**6), st.floats(), plain),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(plain, inner, max_size=3)),
    max_leaves=4,
)
event = st.fixed_dictionaries(
    {"timestamp": st.one_of(plain, value), "level": st.one_of(plain, plain, value), "message": st.one_of(plain, value)},
    optional={"other": value, "more": value},
)


@st.composite
def payload(draw):
    """JSON of an event, often with a character cut out, put in or doubled."""
    text = json.dumps(draw(st.one_of(event, event, value)), ensure_ascii=draw(st.booleans()))
    if draw(st.booleans()):
        at = draw(st.integers(0, len(text)))
        text = text[:at] + draw(st.sampled_from(['"', "{", "}", "[", "]", ",", ":", " ", "\\", "x", "\n", "1", ""])) + text[at + draw(st.integers(0, 1)) :]
    return text


def expected_event(text: str):
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if not isinstance(found, dict):
        return None
    fields = tuple(found.get(name) for name in ("timestamp", "level", "message"))
    return fields if all(isinstance(field, str) for field in fields) else None


@SETTINGS
@given(st.lists(payload(), min_size=40, max_size=60))
def test_exactly_the_valid_events_are_taken(spark, texts):
    rows = [(i, b"\x00\x00\x00\x00\x01" + text.encode()) for i, text in enumerate(texts)]
    found = decode_records(spark.createDataFrame(rows, "i int, value binary")).select("i", "event").collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.i]
        expected = expected_event(text)
        if expected and any("\ud800" <= char <= "\udfff" for field in expected for char in field):
            continue  # half a character is no text
        assert (tuple(row.event) if row.event else None) == expected, text


@SETTINGS
@given(
    st.lists(
        st.one_of(
            st.text("0123456789._+-eE", max_size=8),
            st.text("0123456789infatyINFATY+-.dDfFxX_", max_size=9),
            st.floats().map(repr),
            st.decimals(allow_nan=False, allow_infinity=False, places=2).map(str),
        ),
        min_size=40,
        max_size=80,
    )
)
def test_exactly_the_numbers_are_amounts(spark, texts):
    words = [f"$${text}.." for text in texts]
    df = spark.createDataFrame(list(enumerate(words)), "i int, word string")
    for row in df.select("i", amount_value(amount_text(F.col("word"))).alias("amount")).collect():
        try:
            expected = float(texts[row.i].rstrip("."))
        except ValueError:
            expected = None
        if expected is not None and math.isnan(expected):
            assert math.isnan(row.amount), texts[row.i]
        else:
            assert row.amount == expected, texts[row.i]


@SETTINGS
@given(st.lists(st.datetimes(datetime(1970, 1, 1), datetime(2200, 1, 1)), min_size=50, max_size=100))
def test_times_are_written_like_isoformat_and_read_back(spark, times):
    aware = [time.replace(tzinfo=timezone.utc) for time in times]
    df = spark.createDataFrame(list(enumerate(aware)), "i int, time timestamp")
    text = render_event_time(F.col("time"))
    for row in df.select("i", text.alias("text"), (parse_event_time(text) == F.col("time")).alias("same")).collect():
        assert row.text == aware[row.i].isoformat()
        assert row.same
