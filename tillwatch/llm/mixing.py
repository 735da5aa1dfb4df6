"""Mixing sources to target weights: entropy-balanced document rates, rounded into copies."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import written

#: Weights of the sources in their order, repeating, the words of the mix as a share of all words, and the most copies of a document.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2

WORD = r"[^\x20\x09-\x0D]+"

#: The dual of a source is solved when its words differ from the target by less than this share.
TOLERANCE = 1e-7
MOST_ROUNDS = 200
#: Documents of one source and size that one task orders, on average, to choose which get one more copy.
BUCKET_ROWS = 8192


def document_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, size)``: number of words, 0 for a null text; ``key`` is the source behind ``=``, or empty for null, which so needs no null-safe joins."""
    source = F.col(source_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("key"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def _weighted(histogram: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``(key, source_size, n, weight)`` of each source; weights go by the order of the sources, null last.

    Sources are counted within the ranges of a sort and numbered from the counts of the ranges before, so their number is not bounded by a task.
    """
    size, n = F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n")
    sources = histogram.groupBy("key").agg(size, n)
    ordered = written(sources.orderBy(F.col("key") == "", "key").withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33).alias("part")
    parts = ordered.groupBy(part).agg(F.count("*").alias("sources"))
    before = F.coalesce(F.sum("sources").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("part", before.alias("before"))
    number = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(number, F.lit(len(weights))).cast("int"))
    return ordered.withColumn("part", part).join(starts, "part").select("key", "source_size", "n", weight.alias("weight"))


def water_filled(sources: DataFrame, share: float, most_copies: int) -> DataFrame:
    """Adds ``target``: ``share`` of all words dealt by weight; none above ``most_copies`` times its source, what is over goes to the others by weight.

    Each round is one sum over the sources: the level by which weights are paid rises until no further source is full.
    """
    limit = F.col("source_size") * float(most_copies)
    words, weight, level, full = *sources.agg(F.sum("source_size"), F.sum("weight")).first(), 0.0, -1
    if not words:
        return sources.withColumn("target", F.lit(0.0))
    held = 0.0
    while weight:
        level = (share * words - held) / weight
        over = F.col("weight") * level > limit
        now, held, weight = sources.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if now == full:
            break
        full = now
    return sources.withColumn("target", F.least(F.col("weight") * level, limit))


def _rate(most_copies: int) -> Column:
    """The rate of a document: exponentially tilted by its size, at most ``most_copies``."""
    tilt = F.col("tilt") * F.col("size") / F.col("mean")
    return F.when(tilt >= math.log(most_copies), float(most_copies)).otherwise(F.exp(tilt))


def _exact(amount: Column) -> Column:
    """Decimals add up to the same sum in any order, so every rerun takes the same steps."""
    return F.sum(amount.cast("decimal(38,6)")).cast("double")


def _newton_round(histogram: DataFrame, duals: DataFrame, most_copies: int) -> DataFrame:
    """One Newton step on the logarithm of each source's words, kept between the known bounds of its tilt."""
    rate, words = F.col("rate"), F.col("size") * F.col("rate") * F.col("docs")
    slope = F.when(rate < float(most_copies), words * F.col("size") / F.col("mean")).otherwise(0.0)
    open_ = duals.where(~F.col("done")).drop("done")
    sums = (
        histogram.select("key", "size", F.col("n").alias("docs"))
        .join(open_, "key")
        .withColumn("rate", _rate(most_copies))
        .groupBy(*open_.columns)
        .agg(_exact(words).alias("words"), _exact(slope).alias("slope"))
    )
    below = F.col("words") < F.col("target")
    bounds = sums.withColumns({"low": F.when(below, F.col("tilt")).otherwise(F.col("low")), "high": F.when(below, F.col("high")).otherwise(F.col("tilt"))})
    newton = F.when((F.col("words") > 0) & (F.col("slope") > 0), F.col("tilt") - F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope"))
    # Without a usable step: half way between the bounds, or twice as far where there is none yet.
    halved = (
        F.when(F.col("high") == math.inf, F.greatest(F.col("tilt"), F.lit(0.0)) * 2 + 1)
        .when(F.col("low") == -math.inf, F.least(F.col("tilt"), F.lit(0.0)) * 2 - 1)
        .otherwise((F.col("low") + F.col("high")) / 2)
    )
    done = F.abs(F.col("words") - F.col("target")) <= F.col("target") * TOLERANCE
    step = F.when(done, F.col("tilt")).when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(halved)
    stepped = bounds.withColumn("done", done).withColumn("tilt", step)
    return duals.where("done").unionByName(stepped.select(*duals.columns))


def balanced(histogram: DataFrame, sources: DataFrame, most_copies: int) -> DataFrame:
    """Adds ``tilt`` and ``mean`` (words of a document that has any) to the sources.

    Of all rates between 0 and ``most_copies`` whose words meet the target, the ones of least relative entropy to one copy each
    are ``min(most_copies, exp(tilt x size / mean))``. The tilt is the maximum of a concave dual, one dimension a source: rounds of
    Newton steps, each a sum over the sizes of all open sources, written so that the lineage stays short. A source whose
    target is all it may give, or nothing, needs no step; rounds that do not settle leave the best tilt so far, and rounding meets the target.
    """
    full, none = F.col("target") >= F.col("source_size") * float(most_copies), F.col("target") <= 0
    duals = sources.select(
        "key",
        "source_size",
        "target",
        (F.col("source_size") / F.greatest(F.col("n"), F.lit(1))).alias("mean"),
        F.when(none, -1e300).when(full, 1e300).otherwise(0.0).alias("tilt"),
        F.lit(-math.inf).alias("low"),
        F.lit(math.inf).alias("high"),
        (full | none).alias("done"),
    )
    duals = written(duals, "duals")
    for _ in range(MOST_ROUNDS):
        if duals.where("not done").isEmpty():
            break
        duals = written(_newton_round(histogram, duals, most_copies), "duals")
    return duals.select("key", "source_size", "target", "mean", "tilt")


def round_to_copies(sizes: np.ndarray, docs: np.ndarray, rates: np.ndarray, target: float, most_copies: int) -> np.ndarray:
    """Copies of all documents of each size (descending), as whole numbers whose words come as near the target as the small documents allow.

    What a size misses or has too much goes on to the next smaller one. Every document first stays at one of the two whole
    numbers around its rate; only what then is left over moves some up to 0 or ``most_copies``.
    """
    copies = np.zeros(len(sizes), dtype=np.int64)
    missing = target - float(np.sum(sizes * docs * rates))
    for low, high, second in ((np.floor(rates), np.ceil(rates), False), (np.zeros(len(rates)), np.full(len(rates), float(most_copies)), True)):
        for k in range(len(sizes)):
            size, n = int(sizes[k]), int(docs[k])
            wanted = copies[k] if second else n * rates[k]
            taken = min(max(math.floor(wanted + missing / size + 0.5), n * int(low[k])), n * int(high[k]))
            missing += (wanted - taken) * size
            copies[k] = taken
    return copies


def _rounded(histogram: DataFrame, duals: DataFrame, most_copies: int) -> DataFrame:
    """``(key, size, n, source_size, target, rate, total)``; a group holds the sizes of one source, of which W words have fewer than the root of 2 W."""
    rated = histogram.where("size > 0").join(duals, "key").select("key", "size", "n", "source_size", "target", _rate(most_copies).alias("rate"))

    def copies(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ascending=False, ignore_index=True)
        group["total"] = round_to_copies(group["size"].to_numpy(), group["n"].to_numpy(), group["rate"].to_numpy(), float(group["target"].iloc[0]), most_copies)
        return group

    return rated.groupBy("key").applyInPandas(copies, f"{rated._jdf.schema().toDDL()}, total long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_copies: int = MOST_COPIES,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies``.

    Sizes are words. Sources in code point order, null last and as one source, get ``weights`` in turn. Rates come from
    ``balanced``; of the documents of one source and size, which share a rate, the first by a hash of their id get the odd copies.
    No text is shuffled, and groups of any size are split by that hash. A rerun gives the same copies.

    An empty or null text has size 0, rate 1 and one copy, and adds nothing to the mix. Repeated rows are documents of their
    own. Null ids are one id. Other columns are ignored, and an empty table gives no row.
    """
    sized = written(document_sizes(docs, id_col, source_col, text_col), "sizes")
    histogram = written(sized.groupBy("key", "size").agg(F.count("*").alias("n")), "histogram")
    sources = written(water_filled(_weighted(histogram, weights), share, most_copies), "targets")
    duals = balanced(histogram, sources, most_copies)
    plan = written(_rounded(histogram, duals, most_copies), "copies")
    base = F.floor(F.col("total") / F.col("n")).cast("long")
    odd = plan.select("key", "size", "rate", "n", base.alias("base"), (F.col("total") - base * F.col("n")).alias("odd"))

    draw = F.xxhash64("doc_id", F.lit(11))
    buckets = F.ceil(F.coalesce("n", F.lit(1)) / BUCKET_ROWS)
    placed = sized.join(odd, ["key", "size"], "left").withColumn("bucket", F.pmod(draw, buckets))
    # Dealt by all three: a source and size with most of the rows meets in no task.
    group = ["key", "size", "bucket"]
    dealt = placed.repartition(*group)
    held = dealt.groupBy(*group).agg(F.count("*").alias("held"), F.first("odd").alias("odd"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = held.select(*group, (F.col("odd") - before).alias("more"))
    number = F.row_number().over(Window.partitionBy(*group).orderBy(draw, "doc_id"))
    copies = F.coalesce(F.col("base") + F.when(number <= F.col("more"), 1).otherwise(0), F.lit(1).cast("long"))
    rows = dealt.join(more, group).select("doc_id", "key", "size", F.coalesce("rate", F.lit(1.0)).alias("rate"), copies.alias("copies"))
    source = F.when(F.col("key") != "", F.substr(F.col("key"), F.lit(2)))
    return rows.join(sources.select("key", "source_size", "target"), "key").select("doc_id", source.alias("source"), "size", "source_size", "target", "rate", "copies")


def op11_entropy_mixture(docs: DataFrame) -> DataFrame:
    """The digest of the query."""
    mixed = mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
