"""The wire format: a zero byte, a 4-byte big-endian schema id, then JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAME_BYTES = 5
_REST = 2**31 - 1

# What the parser and the variant type take at most; a valid payload beyond is
# rejected under the name of the limit.
MAX_LEVELS = 1000
MAX_BYTES = 128 * 1024 * 1024

# The parser's defaults would also take 'single quoted' text, and refuse long
# texts and numbers.
_STRICT_JSON = {"allowSingleQuotes": "false", "maxStringLen": str(_REST), "maxNumLen": str(_REST)}


def frame(json_text: Column, schema_id: int) -> Column:
    return F.concat(F.unhex(F.lit(f"00{schema_id:08X}")), json_text.cast("binary"))


def is_framed(value: Column) -> Column:
    return (F.octet_length(value) > FRAME_BYTES) & (F.substring(value, 1, 1) == F.lit(b"\x00"))


def frame_schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")


def frame_text(value: Column) -> Column:
    """Payload as text, NULL where its bytes are not UTF-8."""
    return F.try_validate_utf8(F.substring(value, FRAME_BYTES + 1, _REST).cast("string"))


def variant_fields(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.VariantType()) for name in names])


def json_items(text: Column, fields: T.StructType) -> Column:
    """Parse ``text`` as the only item of a list.

    A bare ``from_json`` stops after the first value, takes trailing text for
    granted and unpacks a one-item list. As a list item, a lone object is the
    only text that yields exactly one non-null item, but see ``closes_early``.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(fields), _STRICT_JSON)


def closes_early(text: Column, fields: T.StructType) -> Column:
    """True if ``text`` itself ends the list of ``json_items`` (``{…}] rest``).

    That needs a ``]``; only such texts are parsed again, as a member of an
    object, which a ``]`` cannot end.
    """
    boxed = F.from_json(
        F.concat(F.lit('{"item":'), text, F.lit("}")), T.StructType([T.StructField("item", fields)]), _STRICT_JSON
    )
    return F.contains(text, F.lit("]")) & boxed["item"].isNull()


def may_be_too_deep(text: Column) -> Column:
    """True if ``text`` opens more brackets than the parser follows; asked only of a text that it refused."""
    return F.regexp_count(text, F.lit(r"[\[{]")) > MAX_LEVELS


def is_too_large(value: Column) -> Column:
    return F.octet_length(value) > MAX_BYTES


def is_json_string(variant: Column) -> Column:
    """True only for a JSON string: not for a missing field, null or number."""
    return F.schema_of_variant(variant).eqNullSafe("STRING")


def json_string(variant: Column) -> Column:
    """Content of a JSON string (a cast; ``variant_get`` costs several times as much)."""
    return variant.cast("string")
