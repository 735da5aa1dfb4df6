"""Messages to typed fields."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwatch.contract import EVENT_KINDS, FAILURE_REASONS, PARSED_SCHEMA
from tillwatch.operators.parse import parse_messages

FIELDS = ("type", "is_failed", "order_id", "amount", "user_id", "ip_address", "payment_id", "fail_reason")


def parse(spark, messages):
    df = spark.createDataFrame(list(enumerate(messages)), "i int, message string")
    rows = parse_messages(df, F.col("message")).orderBy("i").collect()
    return [(tuple(row.parsed), row.parse_error) for row in rows]


def test_schema(spark):
    df = spark.createDataFrame([("x",)], "message string")
    parsed = parse_messages(df, F.col("message")).schema["parsed"].dataType
    assert [(field.name, field.dataType) for field in parsed] == [(f.name, f.dataType) for f in PARSED_SCHEMA]


@pytest.mark.parametrize(
    ("message", "expected"),
    [
        (
            "Payment successful for order order_b1. Amount: $824.23. User: user_000659. Payment ID: pay_0f. IP: 8.8.4.4",
            ("Payment", False, "order_b1", 824.23, "user_000659", "8.8.4.4", "pay_0f", None),
        ),
        (
            "Refund processed for order order_b2. Amount: $10.00. User: user_000001. Refund ID: ref_0f. IP: 8.8.4.4",
            ("Refund", False, "order_b2", 10.0, "user_000001", "8.8.4.4", "ref_0f", None),
        ),
        (
            "Payment FAILED for order order_b3. Amount: $99.90. User: user_010000. Reason: Transaction blocked by bank. IP: 8.8.4.4",
            ("Payment", True, "order_b3", 99.9, "user_010000", "8.8.4.4", None, "Transaction blocked by bank"),
        ),
        (
            "Refund FAILED for order order_b4. Amount: $1000.00. User: user_000002. Reason: Card declined. IP: 8.8.4.4.",
            ("Refund", True, "order_b4", 1000.0, "user_000002", "8.8.4.4", None, "Card declined"),
        ),
        # tabs, runs of blanks, many dots and dollar signs
        (
            "  Payment\tsuccessful  for order order_b...  Amount: $$5.. User: u.. Payment ID: p... IP: 1.2.3.4..\n",
            ("Payment", False, "order_b", 5.0, "u", "1.2.3.4", "p", None),
        ),
        # the mark of a failure is the exact word
        (
            "Payment failed for order o. Amount: $5.00. User: u. Payment ID: p. IP: i",
            ("Payment", False, "o", 5.0, "u", "i", "p", None),
        ),
        # failed without room for a reason: an empty one, not a missing one
        ("Payment FAILED for order o. Amount: $5.00. User: u.", ("Payment", True, "o", 5.0, "u", "u", None, "")),
        (
            "Payment FAILED for order o. Amount: $5.00. User: u. Reason: IP: 1.1.1.1",
            ("Payment", True, "o", 5.0, "u", "1.1.1.1", None, ""),
        ),
        # a reason keeps its inner dots
        (
            "Payment FAILED for order o. Amount: $5.00. User: u. Reason: a. b c... IP: i",
            ("Payment", True, "o", 5.0, "u", "i", None, "a. b c"),
        ),
    ],
)
def test_parsed_fields(spark, message, expected):
    assert parse(spark, [message]) == [(expected, None)]


@pytest.mark.parametrize(
    ("message", "error"),
    [
        (None, "message is null"),
        ("", "message is too short"),
        ("   ", "message is too short"),
        ("short", "message is too short"),
        ("Payment FAILED for order o. Amount: $5.00. User:", "message is too short"),
        ("Payment successful for order o. Amount: $5.00. User: u. Payment ID:", "message is too short"),
        ("Payment successful for order o. Amount: $x. User: u. Payment ID: p. IP: i", "amount is not a number"),
        ("Payment FAILED for order o. Amount: $1.0d. User: u. Reason: r. IP: i", "amount is not a number"),
    ],
)
def test_errors(spark, message, error):
    ((_, found),) = parse(spark, [message])
    assert found == error


name = st.text("abcdef0123456789_", min_size=1, max_size=12)


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(EVENT_KINDS), name, st.integers(1000, 100000), name, name, st.sampled_from(FAILURE_REASONS),
            st.ip_addresses(v=4), st.sampled_from([" ", "  ", "\t", "  "]), st.sampled_from(["", ".", "..."]),
        ),
        min_size=30,
        max_size=60,
    )
)
def test_rendered_fields_come_back(spark, drawn):
    messages, expected = [], []
    for kind, order_id, cents, user_id, payment_id, reason, ip, blank, dots in drawn:
        message = kind.template.format(
            order_id=order_id, amount=cents / 100, user_id=user_id, payment_id=payment_id, refund_id=payment_id,
            reason=reason, ip=ip,
        )
        messages.append((message + dots).replace(" ", blank))
        failed = kind.action.endswith("failed")
        expected.append(
            (
                kind.action.split("_")[0].capitalize(), failed, order_id, cents / 100, user_id, str(ip),
                None if failed else payment_id, reason if failed else None,
            )
        )
    assert parse(spark, messages) == [(fields, None) for fields in expected]


def test_long_message_is_read_whole(spark):
    reason = " ".join(f"word{i}" for i in range(50_000))
    message = f"Payment FAILED for order o. Amount: $5.00. User: u. Reason: {reason}. IP: 1.2.3.4"
    ((fields, error),) = parse(spark, [message])
    assert error is None and fields[7] == reason and fields[5] == "1.2.3.4"
