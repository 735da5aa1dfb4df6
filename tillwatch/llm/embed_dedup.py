"""Near-duplicate embeddings: sign hashing by random hyperplanes, exact cosines, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import finished, written
from tillwatch.llm.components import connected_components

MIN_COSINE = 0.95
#: Chance that a pair of just this cosine meets in no table.
MISS = 5e-4
#: Buckets of evenly spread vectors hold about so many; those of more than BLOCK are compared block by block, in a task so
#: many rows at a time. A crowd of m vectors is sent m / BLOCK times, and a task holds two blocks. Larger buckets take fewer
#: tables, and a vector is sent once a table, which costs about as much as some 500 cosines.
BUCKET = 512
BLOCK = 2048
ROWS = 256
SEED = 11


def table_sizes(n_vectors: int, min_cosine: float = MIN_COSINE) -> tuple[int, int]:
    """Bits of a table, so that buckets stay small as vectors grow in number, and tables, so that a pair at the limit is missed with MISS at most."""
    bits = max(4, ceil(log2(max(2, n_vectors) / BUCKET))) if n_vectors > BUCKET else 4
    meets = (1 - acos(min_cosine) / pi) ** bits
    return bits, ceil(log(MISS) / log(1 - meets))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled by their largest component first, so that no square overflows."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _planes(size: int, bits: int, tables: int) -> np.ndarray:
    """The hyperplanes of all tables for vectors of ``size`` components, in whole numbers; every task draws the same."""
    return np.rint(np.random.default_rng([SEED, size]).normal(size=(size, bits * tables)) * (1 << 10))


def _signs(units: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each vector in each table. Products of whole numbers are exact, so any task finds the same in any company."""
    above = np.rint(units * (1 << 20)) @ planes > 0
    return (above.reshape(len(units), -1, bits) << np.arange(bits)).sum(axis=2, dtype=np.int32)


def _signatures(bits: int, tables: int) -> Column:
    @F.pandas_udf("array<int>")
    def signatures(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        planes: dict[int, np.ndarray] = {}
        for batch in vectors:
            out = [None] * len(batch)
            sizes = batch.map(len)
            for size, part in batch.groupby(sizes):
                if size not in planes:
                    planes[size] = _planes(size, bits, tables)
                values = _signs(unit_rows(np.stack(part.to_list())), planes[size], bits)
                for at, row in zip(part.index, values, strict=True):
                    out[at] = row
            yield pd.Series(out, dtype=object)

    return signatures(F.col("embedding"))


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of equal values in the first ``keys`` columns, across batches."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([np.asarray(batch.column(k)) for k in range(keys)], axis=1)
        starts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for low, high in zip(starts, starts[1:], strict=False):
            key = tuple(values[low])
            if key != last and kept:
                yield pa.Table.from_batches(kept)
                kept = []
            last = key
            kept.append(batch.slice(low, high - low))
    if kept:
        yield pa.Table.from_batches(kept)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component, by passing minima along links and jumping."""
    roots = np.arange(n)
    while True:
        before = roots.copy()
        np.minimum.at(roots, left, before[right])
        np.minimum.at(roots, right, before[left])
        roots = roots[roots]
        if (roots == before).all():
            return roots


def _compare(min_cosine: float, bits: int, tables: int):
    schema = pa.schema([("class_id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compares the members of one or two blocks of a bucket; pairs that met in an earlier table were counted there."""
        planes: dict[int, np.ndarray] = {}
        for group in _groups(batches, 5):
            if group.num_rows < 2:
                continue
            group = group.combine_chunks()
            size, table, one, other = (group[k][0].as_py() for k in ("size", "table", "one", "other"))
            block, ids, copies = (np.asarray(group[k]) for k in ("block", "class_id", "copies"))
            units = unit_rows(_matrix(group["embedding"].chunk(0)))
            rows, columns = np.flatnonzero(block == one), np.flatnonzero(block == other)
            signs = None
            links, roots = np.zeros(len(ids), np.int64), np.arange(len(ids))
            for at in range(0, len(rows), ROWS):
                part = rows[at : at + ROWS]
                left, right = np.nonzero(units[part] @ units[columns].T >= min_cosine)
                left, right = part[left], columns[right]
                if one == other:
                    left, right = left[left < right], right[left < right]
                if not len(left):
                    continue
                if signs is None:
                    if size not in planes:
                        planes[size] = _planes(size, bits, tables)
                    signs = _signs(units, planes[size][:, : bits * table], bits)
                fresh = np.ones(len(left), bool)
                for earlier in signs.T:
                    fresh &= earlier[left] != earlier[right]
                left, right = left[fresh], right[fresh]
                np.add.at(links, left, copies[right])
                np.add.at(links, right, copies[left])
                # What is joined so far goes on as one link a member.
                roots = local_roots(len(ids), np.append(left, np.arange(len(ids))), np.append(right, roots))
            found = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[found]) for x in (ids, links, ids[roots])], schema=schema)

    return compare


def _placed_classes(usable: DataFrame, min_cosine: float) -> DataFrame:
    """Every different vector with its smallest id, a class of its component that all of this have, and its number of links."""
    classes = usable.groupBy("embedding").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    bits, tables = table_sizes(classes.count(), min_cosine)
    signs = _signatures(bits, tables).alias("signs")
    met_at = classes.select("class_id", F.size("embedding").alias("size"), signs).select("class_id", "size", F.posexplode("signs").alias("table", "bucket"))
    # Only ids and keys are grouped and joined; the vector comes in once a class has a bucket with company.
    met_at = written(met_at, "buckets")
    sizes = met_at.groupBy("size", "table", "bucket").count().where("count > 1")
    places = met_at.join(sizes, ["size", "table", "bucket"]).select("class_id", "size", "table", "bucket", "count")
    members = classes.select("class_id", "copies", "embedding").join(places, "class_id")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    members = members.withColumn("block", F.pmod(F.xxhash64("class_id"), blocks).cast("int"))
    members = members.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = ["size", "table", "bucket", "one", "other"]
    dealt = members.select(
        "size", "table", "bucket", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"), "block", "class_id", "copies", "embedding"
    )
    met = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_compare(min_cosine, bits, tables), "class_id long, links long, root long")
    met = written(met, "met")

    links = met.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = connected_components(met, "class_id", "root")
    known = classes.select("class_id", "least_id", "copies", "embedding")
    placed = known.join(links, "class_id", "left").join(roots, known["class_id"] == roots["node"], "left")
    return placed.select("embedding", "least_id", F.coalesce("root", "class_id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors``.

    Equal vectors are one class with a number of copies, which link to each other without being compared. Classes that
    meet in a bucket of any table are compared exactly; a large bucket is dealt to tasks as pairs of blocks, of which each
    passes on counts and the roots of its local components, never pairs. Vectors that are null, zero, or have null or non-finite
    components link with nothing and are their own component, and vectors of different lengths never
    link. Repeated rows are copies. A row without an id counts as a copy; its component is that of its class.
    Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    placed = finished(lambda: _placed_classes(rows.where(_usable(F.col("embedding"))), min_cosine), "placed")
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = placed.join(least, "root").select("embedding", "n_links", "component_id")
    out = rows.join(found, "embedding", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
