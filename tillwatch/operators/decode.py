"""Decode framed JSON records and name what is wrong with the bad ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.contract import EVENT_FIELDS
from tillwatch.functions import wire


def decode_fields(
    records: DataFrame, known_schema_ids: Sequence[int] | None = None, prefix: str = "event_"
) -> DataFrame:
    """Add ``schema_id``, a column per event field and ``defect`` to records with a ``value``.

    ``defect`` is NULL, or it is a struct of ``stage`` (``frame``, ``utf8``,
    ``json`` or ``schema``) and ``error``, and the fields are NULL. Without
    ``known_schema_ids`` every schema id is taken. No row is dropped, and no
    row makes the query fail. A payload that nests deeper than 1000 levels, or
    is larger than 128 MiB and cannot be read for it, is rejected with that
    limit as its error.
    """
    value, text = F.col("value"), F.col("_text")
    items, item = F.col("_items"), F.get(F.col("_items"), F.lit(0))
    fields = wire.variant_fields(EVENT_FIELDS)
    framed = wire.is_framed(value)

    def defect(stage: str, error: str) -> Column:
        return F.struct(F.lit(stage).alias("stage"), F.lit(error).alias("error"))

    refused = (
        F.when(wire.is_too_large(value), defect("json", f"payload is over the limit of {wire.MAX_BYTES} bytes"))
        .when(
            wire.may_be_too_deep(text),
            defect("json", f"payload is over the limit of {wire.MAX_LEVELS} levels, or not one JSON object"),
        )
        .otherwise(defect("json", "payload is not one JSON object"))
    )
    outer = F.when(value.isNull(), defect("frame", "value is null")).when(~framed, defect("frame", "no frame header"))
    if known_schema_ids is not None:
        outer = outer.when(~F.col("schema_id").isin(*known_schema_ids), defect("frame", "unknown schema id"))
    outer = outer.when(text.isNull(), defect("utf8", "payload is not UTF-8"))
    outer = outer.when(wire.closes_early(text, fields), refused)

    inner = F.when(F.col("_outer").isNotNull(), F.col("_outer")).when((F.size(items) != 1) | item.isNull(), refused)
    for name in EVENT_FIELDS:
        unread = F.when(wire.is_too_large(value), F.lit(f"payload is over the limit of {wire.MAX_BYTES} bytes"))
        error = unread.otherwise(F.lit(f"{name} is not a string"))
        inner = inner.when(
            ~wire.is_json_string(item[name]), F.struct(F.lit("schema").alias("stage"), error.alias("error"))
        )

    # One projection per step: each uses results of the one before it several
    # times, so the optimizer keeps them apart and the JSON is parsed once.
    split = records.withColumns(
        {
            "schema_id": F.when(framed, wire.frame_schema_id(value)),
            "_text": F.when(framed, wire.frame_text(value)),
        }
    )
    parsed = split.withColumns({"_items": wire.json_items(text, fields), "_outer": outer})
    sound = F.col("defect").isNull()
    return parsed.withColumn("defect", inner).select(
        *[F.col(name) for name in records.columns],
        "schema_id",
        *[F.when(sound, wire.json_string(item[name])).alias(prefix + name) for name in EVENT_FIELDS],
        "defect",
    )


def decode_records(records: DataFrame, known_schema_ids: Sequence[int] | None = None) -> DataFrame:
    """Add ``schema_id``, the struct ``event`` (NULL if defective) and ``defect``; see ``decode_fields``."""
    prefix = "_event_"
    event = F.struct(*[F.col(prefix + name).alias(name) for name in EVENT_FIELDS])
    return decode_fields(records, known_schema_ids, prefix).select(
        *[F.col(name) for name in records.columns],
        "schema_id",
        F.when(F.col("defect").isNull(), event).alias("event"),
        "defect",
    )
