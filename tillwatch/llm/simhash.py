"""SimHash near-duplicates: pigeonhole blocks find candidates, Hamming distance decides."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import finished, free_prefix, written
from tillwatch.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
#: Up to so many different fingerprints of one bucket are compared pair by pair.
PAIRWISE_UP_TO = 32
#: Shingles whose bits are unpacked at once.
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a text; 0 if it has no word.

    A to Z are lowered, words are runs of anything but ASCII white space, every occurrence
    of a shingle counts, and a bit is set if it is set in more than half the hashes.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    size = min(shingle_words, len(words))
    spans = zip((ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[start:end], seed) for start, end in spans], np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[at : at + _CHUNK], axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints_of(text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(text, shingle_words) for text in batch], dtype="int64")

    return fingerprints(F.col(text_col))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _tables(max_distance: int) -> list[tuple[int, list[int]]]:
    """Mask and free bits of each table: with d + 2 blocks, a pair within d bits agrees in two whole blocks."""
    edges = [64 * i // (max_distance + 2) for i in range(max_distance + 3)]
    blocks = [range(low, high) for low, high in zip(edges, edges[1:], strict=False)]
    out = []
    for kept in combinations(blocks, 2):
        held = {bit for block in kept for bit in block}
        out.append((sum(1 << bit for bit in held), [bit for bit in range(64) if bit not in held]))
    return out


def close_links(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links ``(u, v)`` between different fingerprints ``fp`` that connect all pairs within ``max_distance`` bits, and none but those.

    A bucket of few fingerprints is compared pair by pair. In a larger one, each
    fingerprint is sent to every point that differs from it in up to half the distance; two are within the
    distance exactly if they meet in a point, and those that meet are linked to the
    smallest of them. So a group of n near copies gives about 33 n rows, not n squared,
    and no link that the full comparison would give two components is lost.
    """
    if max_distance % 2 or not 0 < max_distance <= 4:
        raise ValueError("max_distance must be 2 or 4: fingerprints meet halfway")
    tables = _tables(max_distance)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(mask))) for mask, _ in tables])
    buckets = prints.select("fp", F.posexplode(keys).alias("table", "key"))
    sizes = buckets.groupBy("table", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(buckets.join(sizes, ["table", "key"]), "buckets")

    few = members.where(F.col("size") <= PAIRWISE_UP_TO).select("table", "key", "fp")
    pairs = (
        few.withColumnRenamed("fp", "v")
        .join(few.withColumnRenamed("fp", "u"), ["table", "key"])
        .where((F.col("v") < F.col("u")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance))
        .select("u", "v")
    )

    flips = [
        [0, *(_signed(sum(1 << bit for bit in bits)) for n in range(1, max_distance // 2 + 1) for bits in combinations(free, n))]
        for _, free in tables
    ]
    masks = F.element_at(F.array(*[F.array(*[F.lit(flip) for flip in row]) for row in flips]), F.col("table") + 1)
    points = (
        members.where(F.col("size") > PAIRWISE_UP_TO)
        .select("table", "fp", F.explode(masks).alias("flip"))
        .select("table", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    )
    met = points.select(F.col("fp").alias("u"), F.min("fp").over(Window.partitionBy("table", "point")).alias("v")).where("u <> v")
    return pairs.union(met).distinct()


def fingerprint_roots(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``(fp, root)`` for every different fingerprint of ``prints``: ``root`` is the smallest fingerprint of its component."""
    nodes = prints.select("fp").distinct()
    roots = connected_components(close_links(nodes, max_distance))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: components of fingerprints that link within ``max_distance`` bits.

    ``component_id`` is the smallest id of the component. Null and empty texts have
    fingerprint 0 and link like any other; repeated rows stay; a row without an id gets
    the component of its fingerprint (null if that has no id at all); other columns are
    ignored. Copies meet by their fingerprint before any comparison, so a large group of
    them is one node.
    """
    rows = written(docs.select(F.col(id_col).alias("doc_id"), fingerprints_of(text_col, shingle_words).alias("fp")), "prints")
    placed = finished(lambda: fingerprint_roots(rows, max_distance).join(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fp"), "placed")
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    components = placed.join(least, "root").select("fp", "component_id")
    return rows.join(components, "fp").select("doc_id", "fp", "component_id")


def first_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """The rows of ``docs``, with their columns, that come first in their group: smallest id, then first in the table.

    Exactly one row of a group stays, also of repeated rows; a row without an id stays only if its whole group has none.
    """
    prefix = free_prefix(docs)
    row, fp = f"{prefix}row", f"{prefix}fp"
    rows = written(docs.withColumns({row: F.monotonically_increasing_id(), fp: fingerprints_of(text_col, shingle_words)}), "rows")
    prints = rows.select(F.col(id_col).alias("doc_id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    order = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    placed = fingerprint_roots(prints, max_distance).join(prints.groupBy("fp").agg(order), "fp")
    first = placed.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(first, row, "left_semi").select(*[F.col(f"`{name}`") for name in docs.columns])


def op9_simhash_near_dedup(docs: DataFrame) -> DataFrame:
    """The digest of the query: fingerprint as 16 hex digits, and whether the row is the first of its group."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
