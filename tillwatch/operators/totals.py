"""Counts and amount totals per time window, type and outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.contract import WINDOW_LENGTH

# What the totals read of an enriched event.
TOTALS_INPUT = ("event_time", "type", "is_failed", "amount")


# Amounts below this many cents add up as whole cents: a group would need a million million of the largest to go beyond a long.
_CENTS = 10.0**7
# Other amounts below this, with nine places at most, add up as decimals.
_DECIMAL = 10.0**15


def exact_sum(amount: str) -> Column:
    """Sum of doubles as the decimal numbers they are written as: the same in every order and however rows are dealt to tasks.

    Adding doubles rounds at each step, so whether cents that total 10000.00 equal 10000.0 hangs on the order. Here whole cents are
    added as a long, amounts of up to nine places as decimals, and only the result is a double. What fits neither (from
    10^15 on, more places, infinite or not a number) is added as doubles. Null without any amount.
    """
    value, cents = F.col(amount), F.rint(F.col(amount) * 100)
    whole = (F.abs(cents) < _CENTS) & (cents / 100 == value)
    places = value.try_cast("decimal(24,9)")
    other = ~whole & (F.abs(value) < _DECIMAL) & F.coalesce(places.cast("double") == value, F.lit(False))
    exact = F.coalesce(F.sum(F.when(whole, cents.cast("long"))), F.lit(0)).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    fine = F.coalesce(F.sum(F.when(other, places)), F.lit(0))
    rest = F.sum(F.when(~whole & ~other, value))
    total = (exact + fine).cast("double")
    return F.when(F.count(value) > 0, F.when(rest.isNull(), total).otherwise(total + rest))


def window_totals(events: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Tumbling-window totals; events without a time are in no window.

    The sums are partial before the exchange, so one window or type that holds
    most of the events still sends one row per input task.
    """
    return events.groupBy(F.window("event_time", length), "type", "is_failed").agg(
        F.count("*").alias("event_count"), exact_sum("amount").alias("total_amount")
    )


def flat_totals(totals: DataFrame) -> DataFrame:
    """Totals with ``start`` and ``end`` in place of the window struct."""
    return totals.select("window.start", "window.end", *[name for name in totals.columns if name != "window"])


def dropped_events(events: DataFrame, totals: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Windows whose totals miss events that came too late, with how many.

    ``events`` are the enriched events, which keep late ones, and ``totals``
    the latest totals of the same records. The stream's own figure counts rows of
    partial aggregation, not events.
    """
    seen = flat_totals(events.groupBy(F.window("event_time", length)).agg(F.count("*").alias("seen")))
    counted = totals.groupBy("start", "end").agg(F.sum("event_count").alias("counted"))
    missing = F.col("seen") - F.coalesce("counted", F.lit(0))
    return seen.join(counted, ["start", "end"], "left").select("start", "end", missing.alias("dropped")).where("dropped > 0")


def latest_totals(change_log: DataFrame) -> DataFrame:
    """Final totals per group from a log of running totals with their ``batch_id``.

    Batch ids count within a ``stream``. The streams of a log, if it names them, are those of one epoch, where each goes on behind the
    one before: the last state of every stream adds up, so a window that two of them share is whole.
    """
    keys = ["start", "end", "type", "is_failed"]
    by_stream = ["stream"] if "stream" in change_log.columns else []
    last = change_log.groupBy(*keys, *by_stream).agg(*[F.max_by(name, "batch_id").alias(name) for name in ("event_count", "total_amount")])
    if not by_stream:
        return last
    return last.groupBy(*keys).agg(F.sum("event_count").alias("event_count"), exact_sum("total_amount").alias("total_amount"))
