"""Parse payment messages into typed fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.contract import FAILED_WORD, PARSED_SCHEMA
from tillwatch.functions.text import amount_text, amount_value, strip_dots, words

# Word positions: a message names its order, amount and user before word 9,
# a successful one its payment or refund id in word 11. A failed one gives
# its reason from word 10 up to the last two words, "IP:" and the address.
_MIN_WORDS = 9
_MIN_WORDS_WITH_ID = 12
_REASON_START = 10


def parse_fields(df: DataFrame, message: Column, prefix: str = "") -> DataFrame:
    """Add a column per field and ``parse_error`` (NULL if all fields are there).

    Being columns of their own, fields that a query does not read are not computed.
    """
    word_list = F.col("_words")

    def word(position: int) -> Column:
        return F.get(word_list, F.lit(position))

    count = F.size(word_list)
    failed = F.col("_failed")
    reason = F.array_join(F.slice(word_list, _REASON_START + 1, F.greatest(count - _REASON_START - 2, F.lit(0))), " ")
    fields = {
        "type": word(0),
        "is_failed": failed,
        "order_id": strip_dots(word(4)),
        "amount": amount_value(F.col("_amount_text")),
        "user_id": strip_dots(word(8)),
        "ip_address": strip_dots(F.try_element_at(word_list, F.lit(-1))),
        "payment_id": F.when(~failed, strip_dots(word(11))),
        "fail_reason": F.when(failed, strip_dots(reason)),
    }
    error = (
        F.when(word_list.isNull(), "message is null")
        .when(count < F.when(failed, _MIN_WORDS).otherwise(_MIN_WORDS_WITH_ID), "message is too short")
        .when(F.col(f"{prefix}amount").isNull(), "amount is not a number")
    )
    split = df.withColumn("_words", words(message)).withColumns(
        {"_failed": word(1).eqNullSafe(FAILED_WORD), "_amount_text": amount_text(word(6))}
    )
    found = split.withColumns({prefix + name: field for name, field in fields.items()})
    return found.withColumn("parse_error", error).drop("_words", "_failed", "_amount_text")


def parse_messages(df: DataFrame, message: Column) -> DataFrame:
    """Add the struct ``parsed`` and ``parse_error`` (NULL if all fields are there)."""
    prefix = "_parsed_"
    parsed = F.struct(*[F.col(prefix + name).alias(name) for name in PARSED_SCHEMA.names])
    return parse_fields(df, message, prefix).select(
        *[F.col(name) for name in df.columns], parsed.alias("parsed"), "parse_error"
    )
