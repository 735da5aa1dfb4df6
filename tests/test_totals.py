"""Window totals and their change log."""

import math
import operator
import random
from datetime import datetime
from fractions import Fraction
from functools import reduce

import pytest
from tillwatch.contract import TOTALS_SCHEMA
from tillwatch.operators.totals import exact_sum, flat_totals, latest_totals, window_totals

EVENTS = "event_time timestamp, type string, is_failed boolean, amount double"


def at(second: int) -> datetime:
    return datetime(2025, 5, 1, 12, second // 60, second % 60)


def totals(spark, rows, **options):
    found = flat_totals(window_totals(spark.createDataFrame(rows, EVENTS), **options))
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in TOTALS_SCHEMA]
    return {tuple(row)[:4]: tuple(row)[4:] for row in found.collect()}


def test_windows_are_half_open_and_aligned(spark):
    rows = [(at(s), "Payment", False, 1.0) for s in (0, 59, 60, 119, 120)]
    assert totals(spark, rows) == {
        (at(0), at(60), "Payment", False): (2, 2.0),
        (at(60), at(120), "Payment", False): (2, 2.0),
        (at(120), at(180), "Payment", False): (1, 1.0),
    }


def test_missing_values(spark):
    rows = [
        (None, "Payment", False, 5.0),
        (at(1), None, False, 5.0),
        (at(2), None, False, None),
        (at(3), "Payment", None, None),
        (at(4), "Payment", False, 2.0),
        (at(5), "Payment", False, None),
    ]
    assert totals(spark, rows) == {
        (at(0), at(60), None, False): (2, 5.0),
        (at(0), at(60), "Payment", None): (1, None),
        (at(0), at(60), "Payment", False): (2, 2.0),
    }


def test_other_length(spark):
    rows = [(at(s), "Payment", False, 1.0) for s in (0, 59, 60)]
    assert totals(spark, rows, length="2 minutes") == {(at(0), at(120), "Payment", False): (3, 3.0)}


def test_latest_totals(spark):
    log = [
        (at(0), at(60), "Payment", False, 2, 2.0, 0),
        (at(0), at(60), "Payment", False, 5, 9.0, 3),
        (at(0), at(60), "Payment", False, 3, 4.0, 1),
        (at(0), at(60), None, None, 1, None, 2),
        (at(60), at(120), "Payment", True, 1, 5.0, 0),
        (at(60), at(120), "Payment", True, 2, None, 1),
    ]
    schema = "start timestamp, end timestamp, type string, is_failed boolean, event_count long, total_amount double, batch_id long"
    found = {tuple(row) for row in latest_totals(spark.createDataFrame(log, schema)).collect()}
    assert found == {
        (at(0), at(60), "Payment", False, 5, 9.0),
        (at(0), at(60), None, None, 1, None),
        (at(60), at(120), "Payment", True, 2, None),
    }


def test_latest_totals_of_streams_that_continue(spark):
    log = [
        (at(0), at(60), "Payment", False, 2, 0.1, "a", 0),
        (at(0), at(60), "Payment", False, 5, 0.2, "a", 7),
        (at(0), at(60), "Payment", False, 1, 0.1, "b", 0),
        (at(60), at(120), "Payment", True, 1, None, "b", 3),
    ]
    schema = "start timestamp, end timestamp, type string, is_failed boolean, event_count long, total_amount double, stream string, batch_id long"
    found = {tuple(row) for row in latest_totals(spark.createDataFrame(log, schema)).collect()}
    assert found == {(at(0), at(60), "Payment", False, 6, 0.3), (at(60), at(120), "Payment", True, 1, None)}


def sums(spark, groups, tasks=3):
    rows = [(key, amount) for key, amounts in groups.items() for amount in amounts]
    frame = spark.createDataFrame(rows, "key int, amount double").repartition(tasks)
    return {row.key: row.total for row in frame.groupBy("key").agg(exact_sum("amount").alias("total")).collect()}


@pytest.mark.parametrize("tasks", [1, 7, 64])
def test_cents_that_total_a_round_amount_are_equal_to_it(spark, tasks):
    draw = random.Random(8)
    groups = {}
    for key in range(300):
        cents = [draw.randrange(1000, 100_000) for _ in range(19)]
        groups[key] = [cent / 100 for cent in [*cents, 1_000_000 - sum(cents)]]
    assert any(reduce(operator.add, amounts) != 10000.0 for amounts in groups.values())
    assert set(sums(spark, groups, tasks).values()) == {10000.0}


def test_sums_are_those_of_the_decimal_numbers(spark):
    draw = random.Random(9)
    groups = {key: [round(draw.uniform(-1e6, 1e6), draw.randrange(10)) for _ in range(draw.randrange(1, 40))] for key in range(200)}
    found = sums(spark, groups)
    for key, amounts in groups.items():
        assert found[key] == float(sum(Fraction(repr(amount)) for amount in amounts))


def test_sums_of_odd_numbers(spark):
    inf = math.inf
    groups = {1: [None, None], 2: [1e300, 1.0], 3: [inf, 2.0], 4: [-0.0], 5: [1e17, None], 6: [5.25, -5.25], 7: [1e-12], 8: [99_999.99, 0.01], 9: [123456789012.34]}
    assert sums(spark, groups) == {1: None, 2: 1e300, 3: inf, 4: 0.0, 5: 1e17, 6: 0.0, 7: 1e-12, 8: 100_000.0, 9: 123456789012.34}
    assert math.isnan(sums(spark, {1: [math.nan, 1.0]})[1])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert spark.createDataFrame([(1e300,), (0.125,)], "amount double").agg(exact_sum("amount")).first()[0] == 1e300
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
