"""Quality classifier: random Fourier features of text statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import learnable, written

N_FOURIER = 160
RIDGE = 1.0
SEED = 7
#: Scores are counted on a grid of this step before calibration.
GRID = 1 / 1000

_KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:",
    "mark": b"!?",
    "quote": b"'\"()[]{}-_",
    "bar": b"|",
    "sign": b"#$%&*+/<=>@\\^`~",
    "line": b"\n",
    "blank": b" \t\x0b\x0c\r",
    "wide": bytes(range(128, 256)),
    "control": bytes([*range(9), *range(14, 32), 127]),
}
_SHARES = np.zeros((256, len(_KINDS)))
for _k, _chars in enumerate(_KINDS.values()):
    _SHARES[list(_chars), _k] = 1
N_STATS = len(_KINDS) + 7


def text_stats(text: str | None) -> np.ndarray:
    """Statistics of the whole text as N_STATS numbers; zeros if null or empty."""
    out = np.zeros(N_STATS)
    data = text.encode() if text else b""
    if not data:
        return out
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _SHARES
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, n_lines = max(1, len(words)), max(1, len(lines))
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1)
    out[: len(_KINDS)] = np.sqrt(kinds / len(data))
    out[len(_KINDS) :] = (
        np.log1p(len(words)),
        np.log1p((len(data) - kinds[8] - kinds[9]) / n),
        np.log1p(n / n_lines),
        len(set(words)) / n,
        pairs,
        len(set(lines)) / n_lines,
        np.sqrt(len(max(words, key=len, default=b"")) / len(data)),
    )
    return out


def with_stats(docs: DataFrame, text_col: str = "text", name: str = "features") -> DataFrame:
    """Adds the statistics as an array column."""

    @F.pandas_udf("array<double>")
    def stats(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([text_stats(text) for text in batch])

    return docs.withColumn(name, stats(F.col(text_col)))


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, random projection, ridge weights, and the steps of the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    xs: np.ndarray
    ys: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.xs, self.ys)


def fourier(x: np.ndarray) -> np.ndarray:
    """Features whose inner products approximate a Gaussian kernel of width sqrt(number of statistics), and a constant."""
    draw = np.random.default_rng(SEED)
    directions = draw.normal(scale=1 / np.sqrt(N_STATS), size=(N_STATS, N_FOURIER))
    shift = draw.uniform(0, 2 * np.pi, N_FOURIER)
    return np.hstack([np.sqrt(2 / N_FOURIER) * np.cos(x @ directions + shift), np.ones((len(x), 1))])


def _normal_equations(train: DataFrame, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and right side, summed in each partition and then by Spark's own sum, cell by cell."""
    size = N_FOURIER + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                z = fourier((np.vstack(batch["features"].to_list()) - mean) / scale)
                gram += z.T @ np.hstack([z, batch["y"].to_numpy(float)[:, None]])
        yield pd.DataFrame({"row": np.arange(size), "cells": list(gram)})

    rows = train.select("features", "y").mapInPandas(sums, "row int, cells array<double>")
    cells = rows.select("row", F.posexplode("cells").alias("col", "cell")).groupBy("row", "col").agg(F.sum("cell").alias("cell"))
    gram = np.zeros((size, size + 1))
    for row, col, cell in cells.collect():
        gram[row, col] = cell
    return gram[:, :-1], gram[:, -1]


def isotonic(xs: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centre and mean of each block, rising in both."""
    blocks: list[list[float]] = []
    for x, one, count in zip(xs, ones, counts, strict=True):
        blocks.append([x * count, one, count])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _scores(model: QualityModel, calibrated: bool, features: str = "features") -> Column:
    @F.pandas_udf("double")
    def scores(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in rows:
            stats = np.vstack(batch.to_list()) if len(batch) else np.zeros((0, N_STATS))
            yield pd.Series(model.score(stats) if calibrated else model.raw(stats), dtype="float64")

    return scores(F.col(features))


def fit_quality(labelled: DataFrame) -> QualityModel:
    """From all rows of ``features``, ``y`` (0 or 1) and ``part`` (true: the row calibrates, false: it fits).

    Without labelled rows every text scores 0.5.
    """
    moments = labelled.agg(
        *[f(F.col("features")[j]).alias(f"{kind}{j}") for j in range(N_STATS) for kind, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()
    mean, scale = np.array([x or 0.0 for x in moments[::2]]), np.array([max(x or 0.0, 1e-6) for x in moments[1::2]])
    gram, right = _normal_equations(labelled.where(~F.col("part")), mean, scale)
    weights = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), right)
    model = QualityModel(mean, scale, weights, np.array([0.0]), np.array([0.5]))
    # Few labels may leave a part empty; then all of them calibrate.
    cell = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), _scores(model, False))) / GRID).cast("int")
    steps = labelled.select("part", "y", cell.alias("cell")).groupBy("part", "cell").agg(F.sum("y").alias("ones"), F.count("*").alias("n")).collect()
    steps = [r for r in steps if r["part"]] or steps
    if not steps:
        return model
    totals: dict[int, list[int]] = {}
    for r in steps:
        one, n = totals.setdefault(r["cell"], [0, 0])
        totals[r["cell"]] = [one + r["ones"], n + r["n"]]
    cells = sorted(totals)
    xs, ys = isotonic(np.array(cells) * GRID, np.array([totals[c][0] for c in cells]), np.array([totals[c][1] for c in cells]))
    return QualityModel(mean, scale, weights, xs, np.clip(ys, 0.0, 1.0))


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str, str] = ("features", "score", "predicted"), narrow: bool = False
) -> DataFrame:
    """``docs`` with statistics, score (likelihood of label 1) and prediction (1 from a score of 0.5).

    Learns from every labelled row of ``docs`` that is not held out; an id that is labelled both ways
    teaches nothing. Null and empty texts have zero statistics and get a score like any other; repeated
    rows stay. A column named as the added ones (``names``) is replaced.

    The statistics are written with the ids alone. A ``narrow`` result has just these; otherwise the
    statistics are made again beside the other columns, so that no second copy of the texts lies on disk.
    """
    features, score, predicted = names
    docs = docs.drop(*names)
    rows = written(with_stats(docs.select(id_col, text_col), text_col, features).select(id_col, features), "features")
    one = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("y"))
    one = one.where("low = y").select(F.col("doc_id").alias("labelled_id"), "y")
    usable = rows.where(learnable(id_col)).select(F.col(id_col).alias("id"), F.col(features).alias("features"))
    part = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    labelled = written(usable.join(one, F.col("id") == F.col("labelled_id")).select("features", "y", part.alias("part")), "labelled")
    model = fit_quality(labelled)
    out = (rows if narrow else with_stats(docs, text_col, features)).withColumn(score, _scores(model, True, features))
    return out.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
