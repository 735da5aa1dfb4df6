"""Shards of near-equal bytes, by sampled splitters over a key of text hash and id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import written

#: Ranges per shard that the splitters aim at, and sampled keys per range. A range is ordered by one task, with some 40
#: bytes a row: of 100 TB in 16 shards each holds 25 GB of text, about 8 million rows.
RANGES_PER_SHARD = 256
SAMPLES_PER_RANGE = 6
#: A range of more than so many times the aimed size is subdivided.
OVERFULL = 2
#: Splitters are looked up by the leading bits of the text hash.
_PREFIX_BITS = 12

_KEY = ("text_key", "id_key", "doc_id", "pos")


def _sampled(keys: DataFrame, rate: Column, seed: int) -> DataFrame:
    """Keys drawn with a chance of rate x size, from a hash of the row, so a lost task draws the same again."""
    draw = F.pmod(F.xxhash64(*_KEY, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    weight = F.col("size") * rate
    return keys.where(draw < weight).withColumn("weight", F.greatest(F.lit(1.0), weight))


def _quantiles(sample: DataFrame, by: list[str]) -> DataFrame:
    """The keys of a bounded sample where its running weight passes a multiple of about SAMPLES_PER_RANGE."""
    window = Window.partitionBy(*by)
    whole = F.sum("weight").over(window)
    run = F.sum("weight").over(window.orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, 0))
    runs = sample.withColumn("step", whole / F.greatest(F.lit(1), F.round(whole / SAMPLES_PER_RANGE))).withColumn("run", run)
    passes = F.floor(F.col("run") / F.col("step")) > F.floor((F.col("run") - F.col("weight")) / F.col("step"))
    return runs.where(passes).select(F.struct(*_KEY).alias("splitter"))


def _ranges(keys: DataFrame, splitters: DataFrame) -> DataFrame:
    """Adds ``range``: the number of splitters that the key is not below.

    The splitters (a bounded number) are gathered by the leading bits of the text hash and
    joined by them. Those of a row's own prefix are sorted and searched by halving, so a large group of equal texts, which
    has hundreds of them, costs some ten comparisons a row.
    """
    prefix = F.shiftright(F.col("text_key"), 64 - _PREFIX_BITS)
    half = 1 << (_PREFIX_BITS - 1)
    found = splitters.groupBy(F.shiftright("splitter.text_key", 64 - _PREFIX_BITS).alias("prefix")).agg(
        F.array_sort(F.collect_list("splitter")).alias("near"), F.count("*").alias("n")
    )
    # Steps of the search: the powers of two up to their number, the largest first.
    steps = F.transform(F.sequence(F.floor(F.log2("n")).cast("int"), F.lit(0)), lambda power: F.pow(F.lit(2), power).cast("int"))
    found = found.withColumn("steps", steps)
    every = keys.sparkSession.range(-half, half).withColumnRenamed("id", "prefix").join(found, "prefix", "left")
    before = F.coalesce(F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lookup = every.select("prefix", "near", "steps", before.alias("before"))
    key = F.struct(*_KEY)
    passed = F.aggregate("steps", F.lit(0), lambda low, step: F.when(F.get("near", low + step - 1) <= key, low + step).otherwise(low))
    joined = keys.withColumn("prefix", prefix).join(F.broadcast(lookup), "prefix")
    return joined.select(*keys.columns, (F.col("before") + F.coalesce(passed, F.lit(0))).alias("range"))


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` per row, with shards that differ by about one row's bytes.

    The size of a row is the UTF-8 bytes of its text plus 1. Keys are drawn in proportion
    to size, their quantiles cut the key space into ranges, ranges that come out overfull
    are subdivided by a denser draw, and running bytes over the ranges place each row. Equal
    texts are neighbours and share a shard unless a boundary runs through the group, so a large group is split
    rather than kept in one task. The key ends in the row's position, so repeated rows are divided as well.
    Null texts count as empty, null ids sort first, other columns are ignored, an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        F.xxhash64(F.col(id_col)).alias("id_key"),
        F.monotonically_increasing_id().alias("pos"),
    )
    # Written, so that positions stay as they are whatever is computed again.
    keys = written(rows, "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return keys.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    n_ranges = n_shards * RANGES_PER_SHARD
    rate = F.lit(n_ranges * SAMPLES_PER_RANGE / total)
    first = written(_quantiles(_sampled(keys, rate, 1), []), "splitters")
    ranged = _ranges(keys, first)
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    # No more than n_ranges / OVERFULL ranges can be that full; what they hold is drawn again and cut at its own quantiles.
    full = sizes.where(F.col("bytes") > OVERFULL * total / n_ranges).select("range")
    second = _quantiles(_sampled(ranged.join(F.broadcast(full), "range"), rate, 2), ["range"])
    splitters = written(first.union(second).distinct(), "splitters")

    placed = _ranges(keys, splitters)
    totals = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )
    within = Window.partitionBy("range").orderBy(*_KEY)
    ranked = (
        placed.withColumn("run", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(offsets), "range")
    )
    # The middle byte of a row decides.
    middle = F.col("bytes_before") + F.col("run") - (F.col("size") + 1) / 2
    shard = F.least(F.floor(middle * n_shards / total), F.lit(n_shards - 1)).cast("int")
    global_row = F.col("rows_before") + F.col("nth") - 1
    ranked = written(ranked.select("doc_id", "size", "text_crc32", shard.alias("shard"), global_row.alias("row")), "shards")
    starts = ranked.groupBy("shard").agg(F.min("row").alias("start"))
    return ranked.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("start")).alias("slot"))


def op4_sampled_splitter_shards(docs: DataFrame) -> DataFrame:
    """The digest of the query: 16 shards under the law ``bytes``."""
    return shard_by_bytes(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
