"""Alert rules."""

from datetime import datetime

import pytest

from tillwatch.contract import ALERT_SCHEMA, TOTALS_SCHEMA
from tillwatch.operators.alerts import DEFAULT_RULES, PAYMENT_FAILURES, AlertRule, find_alerts, with_limits

START, END = datetime(2025, 5, 1, 12, 0), datetime(2025, 5, 1, 12, 1)


def alerts(spark, *totals, rules=DEFAULT_RULES):
    df = spark.createDataFrame([(START, END, *total) for total in totals], TOTALS_SCHEMA)
    found = find_alerts(df, rules)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in ALERT_SCHEMA]
    return [(row.rule, row.alert_message) for row in found.collect()]


@pytest.mark.parametrize(
    ("total", "expected"),
    [
        (("Payment", True, 10, 24977826.86), "ALERT: High Payment error rate! 10 errors with $24977826.86."),
        (("Payment", True, 9, 10000.0), "ALERT: High Payment error rate! 9 errors with $10000.00."),
        (("Refund", False, 11, 12.5), "ALERT: High Refund requests rate! 11 requests with $12.50$."),
        (("Refund", False, 1, 10000.0), "ALERT: High Refund requests rate! 1 requests with $10000.00$."),
        (("Payment", True, 9, 10000.01), None),
        (("Payment", True, 9, None), None),
        (("Payment", False, 1000, 10000.0), None),
        (("Refund", True, 1000, 10000.0), None),
        (("payment", True, 1000, 10000.0), None),
        ((None, True, 1000, 10000.0), None),
        (("Payment", None, 1000, 10000.0), None),
    ],
)
def test_default_rules(spark, total, expected):
    assert [message for _, message in alerts(spark, total)] == ([] if expected is None else [expected])


def test_amount_alone_can_be_missing(spark):
    assert len(alerts(spark, ("Payment", True, 10, None))) == 1


def test_one_total_can_fire_several_rules(spark):
    again = AlertRule("second", "Payment", True, "%d %.2f", min_count=1, exact_amount=None)
    found = alerts(spark, ("Payment", True, 10, 1.0), rules=(PAYMENT_FAILURES, again))
    assert [rule for rule, _ in found] == ["payment_failures", "second"]


def test_other_limits(spark):
    assert alerts(spark, ("Payment", True, 10, 10000.0), rules=with_limits(11, None)) == []
    assert len(alerts(spark, ("Refund", False, 2, 7.0), rules=with_limits(11, 7.0))) == 1


def test_a_total_without_amounts_reads_null(spark):
    rows = [(None, None, "Payment", True, 12, None), (None, None, "Refund", False, 12, None)]
    found = find_alerts(spark.createDataFrame(rows, TOTALS_SCHEMA)).orderBy("rule").collect()
    assert [row.alert_message for row in found] == [
        "ALERT: High Payment error rate! 12 errors with $null.",
        "ALERT: High Refund requests rate! 12 requests with $null$.",
    ]
