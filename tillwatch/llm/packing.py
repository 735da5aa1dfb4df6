"""Order-preserving packing: windows cut at document or sentence ends, by dynamic programming."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE_TOKENS = 2048
END_ID = 1
#: What a cut costs, in tokens of padding: at the end of a sentence, and inside a long one.
SENTENCE_CUT = 4
INNER_CUT = 16
#: A sentence of more than so many tokens may also be cut after every so many.
INNER_STEP = 32
#: Documents of about so many tokens are optimised together; the last windows are decided with the next ones.
RUN_TOKENS = 1 << 19
OPEN_WINDOWS = 4

# How byte-level vocabularies of this family split a text before merging; a fixed value.
_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CLOSES = re.compile(rb"[.!?][\"')\]]*$")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(byte): byte for byte in printable} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


def _plain(settings: dict) -> bool:
    """Whether a tokenizer file does nothing but split as ``_SPLIT`` does, take bytes and merge them."""
    split, model = settings.get("pre_tokenizer") or {}, settings["model"]
    if settings.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space", True) or not split.get("use_regex", True):
        return False
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    return model.get("type") == "BPE" and not any(model.get(option) for option in options)


class Encoder:
    """Ids that the tokenizers library gives with the whole of a text, without special tokens around them.

    If the file is a plain byte-level BPE and its merges are in the order of the ids, they run in tiktoken, which gives the same
    ids several times faster; otherwise, and for a text with an added token in it, tokenizers runs itself.
    ``path`` None finds the public vocabulary byte_bpe_50k.json where the worker runs.
    """

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.tokenizer = Tokenizer.from_file(str(path))
        # The file may ask for a part of a text, or for more than it.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [token["content"] for token in settings["added_tokens"]]
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        letters, added = _byte_of(), set(self.added)
        pieces = {bytes(map(letters.__getitem__, token)) if letters.keys() >= set(token) else token.encode(): rank for token, rank in vocab.items() if token not in added}
        self.fast = None
        if _plain(settings) and len(pieces) == len(vocab.keys() - added):
            pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in settings["model"]["merges"]]
            made = [vocab["".join(pair)] for pair in pairs]
            if made == sorted(made):
                self.fast = tiktoken.Encoding("pieces", pat_str=_SPLIT, mergeable_ranks=pieces, special_tokens={})
        size = self.tokenizer.get_vocab_size()
        self.closes, self.spaced, self.breaks = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, bool)
        for piece, rank in pieces.items():
            self.closes[rank] = _CLOSES.search(piece) is not None
            self.spaced[rank] = piece[:1].isspace()
            self.breaks[rank] = b"\n" in piece

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of tokens after which a sentence or line ends: a closing mark before white space, or the last token before a line break."""
        closed = self.closes[ids[:-1]] & self.spaced[ids[1:]]
        broken = self.breaks[ids[1:]] & ~self.breaks[ids[:-1]]
        return np.flatnonzero(closed | broken) + 1


def cut_places(ends: np.ndarray, total: int, sequence_tokens: int = SEQUENCE_TOKENS) -> tuple[list[int], list[int]]:
    """Where a document of ``total`` tokens may be cut, and what each cut costs; the last is its end, which costs nothing.

    ``ends`` rise and lie above 0.
    """
    marks = np.append(ends[ends < total], total)
    costs = np.full(len(marks), SENTENCE_CUT)
    costs[-1] = 0
    step = min(INNER_STEP, sequence_tokens)
    gaps = np.diff(marks, prepend=0)
    # Places inside long sentences: the first of each, then every step before its end.
    more = (gaps - 1) // step
    if more.any():
        sentence = np.repeat(np.arange(len(marks)), more)
        nth = np.arange(len(sentence)) - np.repeat(np.cumsum(more) - more, more) + 1
        inner = marks[sentence] - gaps[sentence] + nth * step
        marks, costs = np.append(marks, inner), np.append(costs, np.full(len(inner), INNER_CUT))
        order = np.argsort(marks)
        marks, costs = marks[order], costs[order]
    return marks.tolist(), costs.tolist()


def best_cuts(places: list[int], costs: list[int], sequence_tokens: int = SEQUENCE_TOKENS) -> list[int]:
    """Indices of the cuts, first and last place included, of least padding plus cut costs.

    best[j] = costs[j] + min over i of best[i] + sequence_tokens - (places[j] - places[i]). The padding is linear
    in places[i], so the least best[i] + places[i] of the window is all that is needed: a queue that
    rises from its front holds it, and each place enters and leaves once.
    """
    best, back, keys = [0] * len(places), [0] * len(places), [0] * len(places)
    queue: deque[int] = deque()
    for j, place in enumerate(places):
        if j:
            while places[queue[0]] < place - sequence_tokens:
                queue.popleft()
            i = queue[0]
            best[j], back[j] = keys[i] - place + sequence_tokens + costs[j], i
        key = keys[j] = best[j] + place
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts = [len(places) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


@dataclass
class _Run:
    """Documents of a task that are not packed yet; token positions count from the start of the task."""

    sequence: int
    size: int
    places: list[int] = field(default_factory=lambda: [0])
    costs: list[int] = field(default_factory=lambda: [0])
    docs: deque = field(default_factory=deque)

    def add(self, doc_id: int | None, ids: np.ndarray, ends: np.ndarray) -> None:
        """``ids`` without the closing one."""
        start, total = self.places[-1], len(ids) + 1
        places, costs = cut_places(ends, total, self.size)
        self.docs.append((doc_id, start, total, np.append(ids, END_ID).astype("<u4")))
        self.places += [start + place for place in places]
        self.costs += costs

    def tokens(self) -> int:
        return self.places[-1] - self.places[0]

    def pack(self, last: bool) -> list[tuple]:
        """Pieces of the windows that are settled; the rest stays for the next call."""
        cuts = best_cuts(self.places, self.costs, self.size)
        kept = cuts if last else cuts[: max(1, len(cuts) - OPEN_WINDOWS)]
        pieces = []
        for low, high in zip(kept, kept[1:], strict=False):
            begin, end = self.places[low], self.places[high]
            while self.docs and self.docs[0][1] < end:
                doc_id, start, total, ids = self.docs[0]
                first, stop = max(begin, start) - start, min(end, start + total) - start
                pieces.append((doc_id, first, stop - first, zlib.crc32(ids[first:stop]), total, self.sequence, start + first - begin))
                if start + total > end:
                    break
                self.docs.popleft()
            self.sequence += 1
        self.places, self.costs = self.places[kept[-1] :], self.costs[kept[-1] :]
        return pieces


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence_tokens: int = SEQUENCE_TOKENS, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of at most ``sequence_tokens`` tokens, in the order of the table.

    Each document is its ids and the id 1. A row says which tokens of a document (``start``, ``length``, with the
    CRC-32 of the ids as little-endian 32-bit numbers) stand at which ``offset`` of which sequence. Every task packs the
    rows of its own input split as they come, a run at a time: nothing is shuffled, a group of copies is no
    hot spot, and memory holds one run. Sequence ids are unique and rise in a task, with gaps between
    tasks. Null and empty texts are one token; repeated rows and null ids are packed like any others; other columns are ignored.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        run = _Run(TaskContext.get().partitionId() << 36, sequence_tokens)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "")
                run.add(doc_id, ids, encoder.sentence_ends(ids))
                if run.tokens() >= RUN_TOKENS:
                    yield _batch(run.pack(last=False))
        if run.tokens():
            yield _batch(run.pack(last=True))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(packed, PIECES)


_SCHEMA = pa.schema([(column.split()[0], pa.int64()) for column in PIECES.split(", ")])


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*pieces, strict=True)) or [[]] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], schema=_SCHEMA)


def piece_ids(pieces: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """The pieces with their token ids as an array, for writing the sequences out; ids of ``docs`` must be unique."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            ids = []
            for start, length, text in zip(batch["start"].to_pylist(), batch["length"].to_pylist(), batch["text"].to_pylist(), strict=True):
                whole = np.append(encoder.encode(text or ""), END_ID)
                ids.append(whole[start : start + length].astype(np.int32))
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*kept.schema.names, "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return pieces.join(texts, "doc_id").select(*[name.split()[0] for name in PIECES.split(", ")], "text").mapInArrow(cut, f"{PIECES}, ids array<int>")
