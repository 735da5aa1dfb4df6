"""Quality rules: a learned decision list over text statistics, in DataFrame operations alone."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import free_prefix, learnable, written

MIN_WORDS = 10
#: A text fails the base check if more than this share (in percent) of its words is repeated.
MAX_REPEAT_PERCENT = 20
WINDOW_WORDS = 5

#: Thresholds lie between quantiles of each class; so many of each.
QUANTILES = 40
MAX_CONDITIONS = 4
MAX_RULES = 12
#: On rows that did not grow it, a rule must be right this often and cover this many of what it is to catch.
MIN_PRECISION = 0.9
MIN_CAUGHT = 5

_SPACE = " \t\n\x0b\x0c\r"
FEATURES = ("n_words", "symbol_share", "repeat_share", "dup_line_share", "word_length", "line_words", "upper_share", "digit_share", "mark_share")


def with_stats(docs: DataFrame, text_col: str = "text", stats: str = "stats") -> DataFrame:
    """Adds a struct of counts and shares of the whole text; a null text counts as empty.

    Each step is a projection of its own, so that words, lines and windows are computed once per row.
    """
    docs = docs.drop(stats)
    keep = [F.col(f"`{name}`") for name in docs.columns]
    own = free_prefix(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACE))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    out = docs.select(*keep, words.alias(f"{own}words"), lines.alias(f"{own}lines"))

    n = F.size(f"{own}words")
    at = [lambda i, k=k: F.get(f"{own}words", i + k) for k in range(WINDOW_WORDS)]
    windows = F.when(
        n >= WINDOW_WORDS,
        F.transform(F.sequence(F.lit(0), n - WINDOW_WORDS), lambda i: F.xxhash64(*[word(i) for word in at])),
    )
    out = out.select(
        *keep,
        n.cast("long").alias(f"{own}n"),
        F.length(F.array_join(f"{own}words", "")).cast("long").alias(f"{own}chars"),
        F.size(f"{own}lines").cast("long").alias(f"{own}n_lines"),
        (F.size(f"{own}lines") - F.size(F.array_distinct(f"{own}lines"))).cast("long").alias(f"{own}dup_lines"),
        windows.alias(f"{own}windows"),
    )
    # Only texts with a repeated window go on: their windows are sorted, and equal neighbours give the positions.
    repeats = F.coalesce(F.size(F.array_distinct(f"{own}windows")) < F.size(f"{own}windows"), F.lit(False))
    placed = F.array_sort(F.transform(f"{own}windows", lambda window, i: F.struct(window.alias("h"), i.alias("i"))))
    out = out.select(*keep, f"{own}n", f"{own}chars", f"{own}n_lines", f"{own}dup_lines", F.when(repeats, placed).alias(f"{own}placed"))
    same = lambda x, i: F.coalesce(F.get(f"{own}placed", i)["h"] == x["h"], F.lit(False))
    twice = F.filter(f"{own}placed", lambda x, i: same(x, i - 1) | same(x, i + 1))
    out = out.select(*keep, f"{own}n", f"{own}chars", f"{own}n_lines", f"{own}dup_lines", F.array_sort(F.transform(twice, lambda x: x["i"])).alias(f"{own}starts"))
    covered = F.transform(f"{own}starts", lambda start, i: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(f"{own}starts", i + 1) - start, F.lit(WINDOW_WORDS))))
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda total, x: total + x), F.lit(0)).cast("long")
    count = lambda pattern: F.coalesce(F.regexp_count(F.col(text_col), F.lit(pattern)), F.lit(0)).cast("long")
    out = out.select(
        *keep,
        *[F.col(name) for name in (f"{own}n", f"{own}chars", f"{own}n_lines", f"{own}dup_lines")],
        n_repeat.alias(f"{own}repeat"),
        count("[#*$%&|<>]").alias(f"{own}symbols"),
        count("\\p{Lu}").alias(f"{own}upper"),
        count("[0-9]").alias(f"{own}digits"),
        count("[!?]").alias(f"{own}marks"),
    )
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)).cast("double")
    return out.select(
        *keep,
        F.struct(
            F.col(f"{own}n").alias("n_words"),
            F.col(f"{own}chars").alias("word_chars"),
            F.col(f"{own}symbols").alias("n_symbols"),
            F.col(f"{own}dup_lines").alias("n_dup_lines"),
            F.col(f"{own}repeat").alias("n_repeat_words"),
            ((F.col(f"{own}n") < MIN_WORDS) | (100 * F.col(f"{own}repeat") > MAX_REPEAT_PERCENT * F.col(f"{own}n"))).alias("base_failed"),
            share(f"{own}symbols", f"{own}chars").alias("symbol_share"),
            share(f"{own}repeat", f"{own}n").alias("repeat_share"),
            share(f"{own}dup_lines", f"{own}n_lines").alias("dup_line_share"),
            share(f"{own}chars", f"{own}n").alias("word_length"),
            share(f"{own}n", f"{own}n_lines").alias("line_words"),
            share(f"{own}upper", f"{own}chars").alias("upper_share"),
            share(f"{own}digits", f"{own}chars").alias("digit_share"),
            share(f"{own}marks", f"{own}n").alias("mark_share"),
        ).alias(stats),
    )


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` or ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self, prefix: str = "") -> Column:
        value = F.col(prefix + self.feature)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def holds(rule: Rule, prefix: str = "") -> Column:
    return reduce(and_, [condition.column(prefix) for condition in rule])


def first_rule(rules: list[Rule], prefix: str = "") -> Column:
    """Number of the first rule that holds, null if none does: one ordered conditional expression."""
    chain = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules))):
        chain = F.when(holds(rule, prefix), F.lit(number)).otherwise(chain)
    return chain


def _midpoints(values: set[float]) -> list[float]:
    """Thresholds halfway between neighbouring values, so that a rule keeps its distance from both."""
    ordered = sorted(values)
    return [(low + high) / 2 for low, high in zip(ordered, ordered[1:], strict=False)]


def _interval(feature: str, cuts: list[float]) -> Column:
    """Number of cuts below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut < F.col(feature)))


def _gain(caught: int, wrong: int, before: float) -> float:
    return caught * (log2(caught / (caught + wrong)) - before) if caught else 0.0


def _grow(rows: DataFrame, thresholds: dict[str, list[float]]) -> list[Condition]:
    """Adds the condition of the largest information gain until no wrong row is left or nothing is gained.

    One small aggregation per condition: labelled rows counted by feature and threshold interval.
    """
    names = list(thresholds)
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        covered = rows.where(holds(tuple(rule))) if rule else rows
        counts = covered.select("bad", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin")
        cells = {(r["feature"], r["bin"]): (r["caught"], r["wrong"]) for r in counts.agg(F.sum("bad").alias("caught"), F.sum(1 - F.col("bad")).alias("wrong")).collect()}
        caught = sum(c for (feature, _), (c, _) in cells.items() if feature == 0)
        wrong = sum(w for (feature, _), (_, w) in cells.items() if feature == 0)
        if not caught or not wrong:
            break
        before, best = log2(caught / (caught + wrong)), (0.0, None)
        for feature, name in enumerate(names):
            low_caught = low_wrong = 0
            for bin_, threshold in enumerate(thresholds[name]):
                c, w = cells.get((feature, bin_), (0, 0))
                low_caught, low_wrong = low_caught + c, low_wrong + w
                for above, c, w in ((False, low_caught, low_wrong), (True, caught - low_caught, wrong - low_wrong)):
                    best = max(best, (_gain(c, w, before), Condition(name, above, threshold)), key=lambda x: x[0])
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(rule: list[Condition], rows: DataFrame) -> tuple[Rule, int, int]:
    """The shortest beginning of the rule that is worth most on rows that did not grow it, with what it catches there and gets wrong."""
    starts = [tuple(rule[: k + 1]) for k in range(len(rule))]
    sums = [F.sum(F.when(holds(start), hit).otherwise(0)) for start in starts for hit in (F.col("bad"), 1 - F.col("bad"))]
    found = [value or 0 for value in rows.agg(*[total.alias(f"s{k}") for k, total in enumerate(sums)]).first()]
    scored = [(start, caught, wrong) for start, caught, wrong in zip(starts, found[::2], found[1::2], strict=True)]
    return max(scored, key=lambda x: ((x[1] - x[2]) / max(1, x[1] + x[2]), -len(x[0])))


def learn_rules(labelled: DataFrame, features: tuple[str, ...] = FEATURES) -> list[Rule]:
    """Rules for rows to reject, by sequential covering.

    ``labelled`` has ``bad`` (1 to reject, 0 to keep), ``part`` (true: the row prunes, false: it grows)
    and the features as columns. Every labelled row counts; only sums over threshold intervals reach the
    driver, features x intervals of them. No labelled rows or one class alone: no rules.
    """
    if labelled.agg(F.count_distinct("bad")).first()[0] < 2:
        return []
    levels = [(i + 0.5) / QUANTILES for i in range(QUANTILES)]
    cuts = labelled.groupBy("bad").agg(*[F.percentile_approx(name, levels, 2000).alias(name) for name in features]).collect()
    thresholds = {name: _midpoints({float(x) for row in cuts for x in row[name]}) for name in features}
    bins = [_interval(name, thresholds[name]) for name in features]
    left = written(labelled.select("bad", "part", *features, F.array(*bins).alias("bins")), "binned")
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        grown = _grow(left.where(~F.col("part")), thresholds)
        if not grown:
            break
        rule, caught, wrong = _prune(grown, left.where("part"))
        if caught < MIN_CAUGHT or caught < MIN_PRECISION * (caught + wrong):
            break
        rules.append(rule)
        left = left.where(~holds(rule))
    return rules


def judged(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str, str] = ("stats", "rule", "kept"), carry: list[str] | None = None
) -> tuple[DataFrame, list[Rule]]:
    """``docs`` with its statistics, the rule that rejects it (null if none holds) and whether it is kept, and the rules.

    Rules learn from the labelled rows of ``docs`` that pass the base check and are not held
    out; an id that is labelled both ways teaches nothing. A null or empty text fails the base check. Repeated rows
    stay. Rows keep the columns ``carry`` (all by default); one named as the added ones (``names``) is replaced.
    """
    stats, rule, kept = names
    docs = docs.drop(*names)
    carried = [name for name in (docs.columns if carry is None else carry) if name not in names]
    rows = written(with_stats(docs, text_col, stats).select(*[F.col(f"`{name}`") for name in dict.fromkeys([*carried, id_col, stats])]), "stats")
    one = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    one = one.where("low = high").select(F.col("doc_id").alias("labelled_id"), (1 - F.col("low")).alias("bad"))
    usable = rows.where(~F.col(f"{stats}.base_failed") & learnable(id_col)).select(F.col(id_col).alias("id"), F.col(f"{stats}.*"))
    labelled = usable.join(one, F.col("id") == F.col("labelled_id")).select(
        "bad", (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("part"), *[F.col(name).cast("double").alias(name) for name in FEATURES]
    )
    rules = learn_rules(labelled)
    rows = rows.withColumn(rule, first_rule(rules, f"{stats}."))
    return rows.withColumn(kept, ~F.col(f"{stats}.base_failed") & F.col(rule).isNull()), rules


def _base() -> list[Column]:
    return [F.col(f"stats.{name}").alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]


def op3_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of the query: base statistics, base check, verdict and the rule behind it."""
    rows, _ = judged(docs.select("doc_id", "text"), labels, carry=[])
    return rows.select("doc_id", *_base(), "kept", "rule")


def quality_base_statistics(docs: DataFrame) -> DataFrame:
    """What op3 knows of a text before it learns: base statistics and base check, which SQL can tell too."""
    return with_stats(docs.select("doc_id", "text")).select("doc_id", *_base())
