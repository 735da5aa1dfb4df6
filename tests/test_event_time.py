"""Event time from and to text."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tillwatch.functions.event_time import parse_event_time, render_event_time

NOON = 1746100800  # 2025-05-01 12:00:00 UTC


@pytest.mark.parametrize(
    ("text", "micros"),
    [
        ("2025-05-01T12:00:00.123456+00:00", NOON * 10**6 + 123456),
        ("2025-05-01T12:00:00+00:00", NOON * 10**6),
        ("2025-05-01T12:00:00Z", NOON * 10**6),
        ("2025-05-01 12:00:00", NOON * 10**6),
        ("2025-05-01T14:30:00+02:30", NOON * 10**6),
        ("2025-05-01", (NOON - 12 * 3600) * 10**6),
        ("garbage", None),
        ("", None),
        ("2025-13-01", None),
        (None, None),
    ],
)
def test_parse(spark, text, micros):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(F.unix_micros(parse_event_time(F.col("text")))).first()[0] == micros


@pytest.mark.parametrize("micros", [0, 1, 500000, 999999, 123450])
def test_render_is_what_isoformat_writes(spark, micros):
    time = datetime(2025, 5, 1, 12, 30, 15, micros, tzinfo=timezone.utc)
    rendered = spark.range(1).select(render_event_time(F.lit(time)).alias("text"))
    assert rendered.first().text == time.isoformat()
    assert rendered.select(parse_event_time(F.col("text")) == F.lit(time)).first()[0]
