"""Weighted choice and message rendering over columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_choice(draw: Column, choices: Sequence[tuple[str, int]]) -> Column:
    """Choice whose cumulated weight first exceeds ``draw`` (0 to total weight - 1)."""
    limit = 0
    picked = F
    for name, weight in choices:
        limit += weight
        picked = picked.when(draw < limit, F.lit(name))
    return picked


def render_template(template: str, fields: Mapping[str, Column]) -> Column:
    """``concat`` of the literal parts of a format string and its field columns."""
    parts = []
    for text, name, spec, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(F.format_string(f"%{spec}", fields[name]) if spec else fields[name])
    return F.concat(*parts)
