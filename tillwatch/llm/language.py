"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import free_prefix, learnable

UNKNOWN = "und"
HIDDEN = 12
#: The bounded training sample: documents of each language, and units from all over each of them.
DOCS_PER_LANGUAGE = 300
UNITS_PER_DOC = 60
MAX_LANGUAGES = 300
STEPS = 500
BATCH = 256
RATE = 0.02
#: The network reads a text in units: runs without white space, of at most so many characters.
UNIT_CHARS = 24
_UNITS = re.compile(rf"\S{{1,{UNIT_CHARS}}}")
_REMEMBERED = 1 << 19


def units_of(text: str) -> list[str]:
    return _UNITS.findall(text.lower())


def _bytes(unit: str) -> bytes:
    """What the network reads for a unit: its UTF-8 bytes between two blanks."""
    return b" " + unit.encode() + b" "


@dataclass
class ByteNetwork:
    """For each direction a table of inputs by byte (256 x 3H) and recurrent weights (H x 3H); output weights over both states.

    Of the 3H columns, the first H are the update gate, the next the reset gate, the last the candidate.
    """

    languages: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(languages: list[str], seed: int = 0, hidden: int = HIDDEN) -> ByteNetwork:
        draw = np.random.default_rng(seed)
        normal = lambda *shape, scale: draw.normal(scale=scale, size=shape).astype(np.float32)
        return ByteNetwork(
            languages,
            [normal(256, 3 * hidden, scale=0.5) for _ in range(2)],
            [normal(hidden, 3 * hidden, scale=hidden**-0.5) for _ in range(2)],
            normal(2 * hidden, len(languages), scale=(2 * hidden) ** -0.5),
            np.zeros(len(languages), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias]

    def _run(self, data: np.ndarray, way: int, trace: list | None = None) -> np.ndarray:
        """States (T x N x H) after each byte of ``data`` (T x N), which is in reading order of this direction."""
        table, weights = self.inputs[way], self.recurrent[way]
        size = len(weights)
        state = np.zeros((data.shape[1], size), np.float32)
        states = np.empty((*data.shape, size), np.float32)
        for t, column in enumerate(data):
            given, back = table[column], state @ weights
            gates = 0.5 * np.tanh(0.5 * (given[:, : 2 * size] + back[:, : 2 * size])) + 0.5
            update, reset = gates[:, :size], gates[:, size:]
            candidate = np.tanh(given[:, 2 * size :] + reset * back[:, 2 * size :])
            if trace is not None:
                trace.append((state, update, reset, candidate, back[:, 2 * size :]))
            state = candidate + update * (state - candidate)
            states[t] = state
        return states

    def states(self, data: np.ndarray, traces: tuple[list, list] | None = None) -> np.ndarray:
        """Both directions' states at every position of ``data`` (N x T bytes), T x N x 2H."""
        forward = np.ascontiguousarray(data.T)
        first, second = traces or (None, None)
        return np.concatenate([self._run(forward, 0, first), self._run(forward[::-1], 1, second)[::-1]], axis=2)

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        scores = states @ self.output + self.bias
        scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
        return scores / scores.sum(axis=-1, keepdims=True)

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradients by backpropagation through time."""
        traces: tuple[list, list] = ([], [])
        states = self.states(data, traces)
        found = self.probabilities(states)
        times, n = found.shape[:2]
        rows = np.arange(n)
        loss = -np.log(found[:, rows, labels] + 1e-9).mean()
        wrong = found
        wrong[:, rows, labels] -= 1
        wrong /= times * n
        size = len(self.recurrent[0])
        flat = states.reshape(-1, 2 * size)
        by_output = flat.T @ wrong.reshape(-1, wrong.shape[2])
        by_state = wrong @ self.output.T
        by_inputs, by_recurrent = [], []
        for way in range(2):
            # In reading order of the direction.
            columns = data.T if way == 0 else data.T[::-1]
            above = by_state[..., :size] if way == 0 else by_state[::-1, :, size:]
            weights = self.recurrent[way]
            to_input, to_weights = np.zeros_like(self.inputs[way]), np.zeros_like(weights)
            later = np.zeros((n, size), np.float32)
            for t in range(times - 1, -1, -1):
                before, update, reset, candidate, back = traces[way][t]
                at_state = above[t] + later
                at_candidate = at_state * (1 - update) * (1 - candidate**2)
                at_update = at_state * (before - candidate) * update * (1 - update)
                at_reset = at_candidate * back * reset * (1 - reset)
                at_given = np.concatenate([at_update, at_reset, at_candidate], axis=1)
                at_back = np.concatenate([at_update, at_reset, at_candidate * reset], axis=1)
                np.add.at(to_input, columns[t], at_given)
                to_weights += before.T @ at_back
                later = at_state * update + at_back @ weights.T
            by_inputs.append(to_input)
            by_recurrent.append(to_weights)
        return float(loss), [*by_inputs, *by_recurrent, by_output, wrong.sum(axis=(0, 1))]


def train(samples: list[tuple[str, str]], steps: int = STEPS, seed: int = 0) -> ByteNetwork | None:
    """A network from (language, unit) samples, by Adam over batches of units of one length; None without samples."""
    languages = sorted({language for language, _ in samples})
    if not languages:
        return None
    number = {language: k for k, language in enumerate(languages)}
    by_length: dict[int, dict[int, list[bytes]]] = defaultdict(lambda: defaultdict(list))
    total: dict[int, int] = defaultdict(int)
    for language, unit in sorted(samples):
        data = _bytes(unit)
        by_length[len(data)][number[language]].append(data)
        total[len(data)] += len(data)
    arrays = {length: {k: np.array([list(x) for x in units]) for k, units in kinds.items()} for length, kinds in by_length.items()}
    network = ByteNetwork.fresh(languages, seed)
    draw = np.random.default_rng(seed)
    lengths = sorted(total)
    shares = np.array([total[x] for x in lengths]) / sum(total.values())
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    for step in range(1, steps + 1):
        kinds = arrays[int(draw.choice(lengths, p=shares))]
        # The languages of a length get equal parts of the batch.
        each = max(1, BATCH // len(kinds))
        data = np.concatenate([units[draw.integers(0, len(units), each)] for units in kinds.values()])
        labels = np.repeat(list(kinds), each)
        _, gradients = network.gradients(data, labels)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for value, gradient, (mean, square) in zip(network.parameters(), gradients, moments, strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    return network


class Reader:
    """Sums of position probabilities by unit, each unit run through the network once while it is remembered."""

    def __init__(self, network: ByteNetwork):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.sums = np.zeros((1 << 14, len(self.network.languages)), np.float32)
        self.positions = np.zeros(1 << 14, np.int64)

    def learn(self, units: Iterable[str]) -> None:
        if len(self.place) > _REMEMBERED:
            self._forget()
        fresh = list(set(units).difference(self.place))
        old, new = len(self.place), len(self.place) + len(fresh)
        if new > len(self.sums):
            self.sums, self.positions = np.resize(self.sums, (2 * new, self.sums.shape[1])), np.resize(self.positions, 2 * new)
        self.place.update(zip(fresh, range(old, new), strict=True))
        self.sums[old:new], self.positions[old:new] = 0, 0
        by_length: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for at, unit in enumerate(fresh, old):
            # A unit without a letter says nothing about the language.
            if any(map(str.isalpha, unit)):
                data = _bytes(unit)
                by_length[len(data)].append((at, data))
        for length, rows in by_length.items():
            for low in range(0, len(rows), 4096):
                part = rows[low : low + 4096]
                data = np.frombuffer(b"".join(x for _, x in part), np.uint8).reshape(len(part), length)
                found = self.network.probabilities(self.network.states(data)[1:-1])
                at = [x for x, _ in part]
                self.sums[at], self.positions[at] = found.sum(axis=0), length - 2

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and probability of each text: the mean over all its positions."""
        languages, scores = [], []
        for low in range(0, len(texts), 256):
            rows = [units_of(text) if text else [] for text in texts[low : low + 256]]
            try:
                places = [list(map(self.place.__getitem__, row)) for row in rows]
            except KeyError:
                self.learn(chain.from_iterable(rows))
                places = [list(map(self.place.__getitem__, row)) for row in rows]
            # One row of sums per text, by running over the units of all of them.
            sizes = np.array([len(row) for row in places])
            flat = np.fromiter(chain.from_iterable(places), np.int64, sizes.sum())
            text = np.repeat(np.arange(len(sizes)), sizes)
            counts = np.bincount(text, self.positions[flat], len(sizes))
            sums = self.sums[flat]
            totals = np.stack([np.bincount(text, sums[:, k], len(sizes)) for k in range(sums.shape[1])], axis=1)
            for n, total in zip(counts, totals, strict=True):
                if not n:
                    languages.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                pooled = total / n
                best = int(pooled.argmax())
                languages.append(self.network.languages[best])
                scores.append(float(min(1.0, pooled[best])))
        return languages, scores


def training_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """The bounded sample: DOCS_PER_LANGUAGE documents of each language by the hash of their id, UNITS_PER_DOC units spread over each.

    Of more than MAX_LANGUAGES languages, those with the most documents are learned, the first by name of equals.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(learnable("id") & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count_distinct("id").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    # Every row is drawn or not by the hash of its id, at a rate that gives each language somewhat more ids than are taken;
    # so what meets in a task to be ordered is bounded as well.
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F
    for row in sizes:
        rate = rate.when(F.col("lang") == row["lang"], min(1.0, 2 * DOCS_PER_LANGUAGE / row["n"]))
    drawn = rows.select("id", "lang").where(draw < rate.otherwise(0.0) if sizes else F.lit(False)).distinct()
    order = Window.partitionBy("lang").orderBy(draw, "id")
    chosen = drawn.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= DOCS_PER_LANGUAGE)

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text, language in zip(batch["text"], batch["lang"], strict=True):
                read = [unit for unit in units_of(text or "") if any(map(str.isalpha, unit))]
                step = max(1, len(read) // UNITS_PER_DOC)
                found += [(language, unit) for unit in read[step // 2 :: step][:UNITS_PER_DOC]]
            yield pd.DataFrame(found, columns=["lang", "unit"], dtype=object)

    # At most DOCS_PER_LANGUAGE x MAX_LANGUAGES ids are sent to every task.
    sample = rows.join(F.broadcast(chosen.select("id", "lang")), ["id", "lang"]).select("text", "lang")
    return [tuple(row) for row in sample.mapInPandas(units, "lang string, unit string").collect()]


def fit_language(docs: DataFrame, **columns: str) -> ByteNetwork | None:
    return train(training_units(docs, **columns))


def identify(docs: DataFrame, network: ByteNetwork | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text.

    A text that is null or without a letter, and every text if nothing could be learned, is ``und`` with score 0.
    Columns of these names are replaced; repeated rows stay.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(network) if network else None
        for batch in texts:
            if reader is None:
                found = [UNKNOWN] * len(batch), [0.0] * len(batch)
            else:
                found = reader.predict(batch.to_list())
            yield pd.DataFrame({"lang_pred": pd.Series(found[0], dtype=object), "score": pd.Series(found[1], dtype="float64")})

    found = f"{free_prefix(docs)}language"
    kept = [F.col(f"`{name}`") for name in docs.columns if name not in ("lang_pred", "score")]
    return docs.withColumn(found, predict(F.col(text_col))).select(*kept, f"{found}.lang_pred", f"{found}.score")


def language_spans(docs: DataFrame, network: ByteNetwork, text_col: str = "text", name: str = "language_spans") -> DataFrame:
    """``docs`` with the runs of one language: character offset, length and language, from the labels of all positions.

    A unit takes the language that its positions sum to; neighbours of one language join. Null texts give null.
    """

    @F.pandas_udf("array<struct<start: int, length: int, lang: string>>")
    def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(network)
        for batch in texts:
            out = []
            for text in batch:
                if text is None:
                    out.append(None)
                    continue
                runs: list[dict] = []
                matches = list(_UNITS.finditer(text))
                low = [match[0].lower() for match in matches]
                if any(unit not in reader.place for unit in low):
                    reader.learn(low)
                for match, unit in zip(matches, low, strict=True):
                    at = reader.place[unit]
                    if not reader.positions[at]:
                        continue
                    language = network.languages[int(reader.sums[at].argmax())]
                    if runs and runs[-1]["lang"] == language:
                        runs[-1]["length"] = match.end() - runs[-1]["start"]
                    else:
                        runs.append({"start": match.start(), "length": match.end() - match.start(), "lang": language})
                out.append(runs)
            yield pd.Series(out, dtype=object)

    return docs.withColumn(name, spans(F.col(text_col)))
