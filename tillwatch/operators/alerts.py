"""Alert rules over window totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.contract import ALERT_EXACT_AMOUNT, ALERT_MIN_COUNT, PAYMENT_ALERT_TEXT, REFUND_ALERT_TEXT


@dataclass(frozen=True)
class AlertRule:
    """Alert on one type and outcome from a count on, or at an exact amount."""

    name: str
    type: str
    is_failed: bool
    text: str
    min_count: int = ALERT_MIN_COUNT
    exact_amount: float | None = ALERT_EXACT_AMOUNT

    def concerns(self) -> Column:
        return (F.col("type") == self.type) & (F.col("is_failed") == self.is_failed)

    def fires(self) -> Column:
        reached = F.col("event_count") >= self.min_count
        if self.exact_amount is None:
            return reached
        return reached | (F.col("total_amount") == self.exact_amount)

    def message(self) -> Column:
        """The text; a total without any amount reads ``null``."""
        count, total = F.col("event_count"), F.col("total_amount")
        without = F.format_string(self.text.replace("%.2f", "%s"), count, F.lit("null"))
        return F.when(total.isNull(), without).otherwise(F.format_string(self.text, count, total))


PAYMENT_FAILURES = AlertRule("payment_failures", "Payment", True, PAYMENT_ALERT_TEXT)
REFUND_VOLUME = AlertRule("refund_volume", "Refund", False, REFUND_ALERT_TEXT)
DEFAULT_RULES = (PAYMENT_FAILURES, REFUND_VOLUME)


def with_limits(min_count: int, exact_amount: float | None) -> tuple[AlertRule, ...]:
    """The default rules with other limits."""
    return tuple(replace(rule, min_count=min_count, exact_amount=exact_amount) for rule in DEFAULT_RULES)


def find_alerts(totals: DataFrame, rules: Sequence[AlertRule] = DEFAULT_RULES) -> DataFrame:
    """One row per total and rule that fires, with ``rule`` and ``alert_message``.

    The first filter reads grouping columns only, so in a batch it moves below
    the aggregation and the other groups are never shuffled.
    """
    concerned = totals.where(reduce(or_, [rule.concerns() for rule in rules]))
    fired = F.array(
        *[
            F.when(
                rule.concerns() & rule.fires(),
                F.struct(F.lit(rule.name).alias("rule"), rule.message().alias("alert_message")),
            )
            for rule in rules
        ]
    )
    return concerned.select(*totals.columns, F.explode(fired).alias("_alert")).where("_alert is not null").select(
        *totals.columns, "_alert.rule", "_alert.alert_message"
    )
