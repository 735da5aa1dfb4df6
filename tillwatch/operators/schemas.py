"""Records of many schemas: required fields and their types, chosen by the schema id of each record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions import wire

#: Columns of a table of schemas: a row per field that records of an id must have. Another field of a record is of no concern.
SCHEMA_TABLE = T.StructType([T.StructField("schema_id", T.LongType()), T.StructField("field", T.StringType()), T.StructField("type", T.StringType())])
#: A table with at most so many ids is sent to every task; a larger one is joined by a shuffle.
MOST_SENT = 10_000

# How JSON types read from a variant: whole numbers are numbers as well, and any number may be written with places.
_TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT<",
    "array": "^ARRAY<",
    "any": "^",
}


def checked_schemas(schemas: DataFrame) -> DataFrame:
    """``(schema_id, fields)``: one row per id, its fields by name as structs ``(field, type, pattern)``.

    A field named twice must have one type. Names and types must be given, and a type must be one of string, integer, number,
    boolean, object, array and any, else ``ValueError``.
    """
    wrong = schemas.where(F.col("schema_id").isNull() | F.col("field").isNull() | F.col("type").isNull() | ~F.col("type").isin(*_TYPES)).head(1)
    twice = schemas.groupBy("schema_id", "field").agg(F.count_distinct("type").alias("types")).where("types > 1").head(1)
    if wrong or twice:
        raise ValueError(f"not a schema field: {(wrong or twice)[0].asDict()}")
    patterns = F.create_map(*[F.lit(cell) for pair in _TYPES.items() for cell in pair])
    field = F.struct("field", "type", F.element_at(patterns, F.col("type")).alias("pattern"))
    return schemas.groupBy("schema_id").agg(F.sort_array(F.collect_set(field)).alias("fields"))


def decode_by_schema(records: DataFrame, schemas: DataFrame) -> DataFrame:
    """Add ``schema_id``, ``fields`` and ``defect`` to records with a ``value``, each checked by the schema its frame names.

    ``fields`` is a map from the required fields to their JSON content (text of strings, JSON of anything else), NULL for a defective
    record. ``defect`` is NULL or a struct of ``stage`` and ``error``, as ``decode_fields`` has it: stage ``frame`` for a missing frame or an id
    without a schema, ``utf8``, ``json``, and ``schema`` for the first field, by name, that is missing, null or of another type. No row is
    dropped and none makes the query fail. A field that a payload names twice counts as its first. Limits of depth and size are those of ``decode_fields``.

    The schemas are sent to every task if their ids are few, and joined by a shuffle otherwise; a payload is parsed once either way.
    """
    known = checked_schemas(schemas).select(F.col("schema_id").alias("_id"), F.col("fields").alias("_required"))
    if known.limit(MOST_SENT + 1).count() <= MOST_SENT:
        known = F.broadcast(known)
    value, text, item = F.col("value"), F.col("_text"), F.get(F.col("_items"), F.lit(0))
    framed = wire.is_framed(value)
    split = records.withColumns({"schema_id": F.when(framed, wire.frame_schema_id(value)), "_text": F.when(framed, wire.frame_text(value))})
    joined = split.join(known, F.col("schema_id") == F.col("_id"), "left")
    members = T.MapType(T.StringType(), T.VariantType())
    parsed = joined.withColumns({"_items": wire.json_items(text, members), "_closes": wire.closes_early(text, members)})

    def kind(field: Column) -> Column:
        return F.schema_of_variant(F.element_at(item, field["field"]))

    # nothing, and the JSON null, are of type VOID or NULL
    fits = lambda field: F.coalesce((kind(field) != "VOID") & F.regexp_like(kind(field), field["pattern"]), F.lit(False))
    unfit = F.get(F.filter("_required", lambda field: ~fits(field)), F.lit(0))

    def defect(stage: str, error: Column | str) -> Column:
        return F.struct(F.lit(stage).alias("stage"), (F.lit(error) if isinstance(error, str) else error).alias("error"))

    too_large = wire.is_too_large(value)
    refused = (
        F.when(too_large, defect("json", f"payload is over the limit of {wire.MAX_BYTES} bytes"))
        .when(wire.may_be_too_deep(text), defect("json", f"payload is over the limit of {wire.MAX_LEVELS} levels, or not one JSON object"))
        .otherwise(defect("json", "payload is not one JSON object"))
    )
    found = (
        F.when(value.isNull(), defect("frame", "value is null"))
        .when(~framed, defect("frame", "no frame header"))
        .when(F.col("_id").isNull(), defect("frame", "unknown schema id"))
        .when(text.isNull(), defect("utf8", "payload is not UTF-8"))
        .when(F.col("_closes") | (F.size("_items") != 1) | item.isNull(), refused)
        .when(unfit.isNotNull(), defect("schema", F.concat(unfit["field"], F.lit(" is not of type "), unfit["type"])))
    )
    names = F.transform("_required", lambda field: field["field"])
    contents = F.transform("_required", lambda field: F.element_at(item, field["field"]).cast("string"))
    checked = parsed.withColumns({"defect": found})
    return checked.select(
        *[F.col(name) for name in records.columns],
        "schema_id",
        F.when(F.col("defect").isNull(), F.map_from_arrays(names, contents)).alias("fields"),
        "defect",
    )
