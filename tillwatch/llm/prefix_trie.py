"""Prefix trie of conversations by vertical bitmaps: postings of (position, turn), intersected depth first per shard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: A shard holds the conversations whose ids agree but for so many low bits; a bitset has a bit for each.
SHARD_BITS = 10
#: Conversations start again from those whose id is a multiple of BASE, with fewer than MOST_SHARED of its turns.
BASE = 20
MOST_SHARED = 4

_ROOT = bytes(16)
_NOTHING = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, said, words)``: turns from 0, by turn number with null first, then by ``said``, the MD5 of role and text.

    A null role or text is empty; rows without a ``conv_id`` are left out.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "said")
    return turns.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "said", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, said, words)`` of conversations that start with turns of another one, and a row with place -1 for each.

    Conversation c takes the first crc32(c) % 4 turns of c - c % 20 (fewer if it has fewer, none if it is not there), then its own behind as many.
    """
    shared = F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED
    heads = turns.where((F.col("conv_id") % BASE == 0) & (F.col("place") < MOST_SHARED - 1))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "said", "words"))).alias("head"))
    every = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % BASE).alias("base"), shared.alias("shared"))
    every = written(every.join(heads, "base", "left").select("conv_id", "shared", F.filter("head", lambda turn: turn["place"] < F.col("shared")).alias("head")), "heads")
    known = F.coalesce(F.size("head"), F.lit(0))
    own = turns.join(every.select("conv_id", "shared", F.when(F.col("head").isNull(), 0).otherwise(known).alias("known")), "conv_id")
    own = own.where("place >= shared").select("conv_id", (F.col("place") - F.col("shared") + F.col("known")).alias("place"), "said", "words")
    first = every.select("conv_id", F.explode("head").alias("turn")).select("conv_id", "turn.*")
    start = every.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("binary").alias("said"), F.lit(0).cast("long").alias("words"))
    return start.union(first).union(own)


def _lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def _members(bits: int, base: int) -> list[int]:
    found = []
    while bits:
        found.append(base + _lowest(bits))
        bits &= bits - 1
    return found


def shard_trie(shard: int, rows: Iterator[tuple[int, int, bytes, int]]) -> list[tuple]:
    """``(at, node, parent, depth, members, least, words, ends)`` of one shard's nodes, parents before children.

    The index has a bitset of conversations for each place and turn, and one for each length. A node's members go down to a child
    by an intersection with the posting of the next turn of their least one; the rest is split the same way.
    """
    base = shard << SHARD_BITS
    postings: dict[tuple[int, bytes], int] = {}
    words_of: dict[tuple[int, bytes], int] = {}
    turns: dict[int, dict[int, bytes]] = {}
    for conv_id, place, said, words in rows:
        own = turns.setdefault(conv_id - base, {})
        if place >= 0:
            own[place] = said
            postings[place, said] = postings.get((place, said), 0) | 1 << (conv_id - base)
            words_of[place, said] = words
    lengths: dict[int, int] = {}
    for conv, own in turns.items():
        lengths[len(own)] = lengths.get(len(own), 0) | 1 << conv
    found: list[tuple] = []
    stack = [(sum(1 << conv for conv in turns), 0, _ROOT, None, 0)]
    while stack:
        members, depth, node, parent, words = stack.pop()
        ends = members & lengths.get(depth, 0)
        found.append((len(found), node, parent, depth, members.bit_count(), base + _lowest(members), words, _members(ends, base)))
        rest = members ^ ends
        while rest:
            said = turns[_lowest(rest)][depth]
            child = rest & postings[depth, said]
            rest ^= child
            stack.append((child, depth + 1, hashlib.blake2b(node + said, digest_size=16).digest(), node, words_of[depth, said]))
    return found


_NODES = "shard long, at long, node binary, parent binary, depth long, members long, least long, words long, ends array<long>"


def _shard_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of all shards. A shard has at most 2 to the power of SHARD_BITS conversations, and some 100 bytes a turn in memory."""
    names = [part.split()[0] for part in _NODES.split(", ")]

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        nodes = shard_trie(shard, zip(group["conv_id"].tolist(), group["place"].tolist(), group["said"].tolist(), group["words"].tolist(), strict=True))
        return pd.DataFrame([(shard, *node) for node in nodes], columns=names)

    return rows.groupBy(F.shiftright("conv_id", SHARD_BITS).alias("shard")).applyInPandas(build, _NODES)


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``(node, leaves, saved, parent_least, …)`` of each shard's nodes: what the shard adds to the subtrees.

    A node saves its words once less than it has members. Every shard counts its own members, and the shard of the least member
    takes away the one that stays, as it counts a leaf. So sums over shards are those of the whole trie.
    """
    schema = "node binary, depth long, least_of_all long, n_convs long, n_children long, leaves long, saved long, parent_least long"

    def add_up(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at", ignore_index=True)
        own = (group["least_of_all"].to_numpy() >> SHARD_BITS) == int(key[0])
        leaves = (own & (group["n_children"].to_numpy() == 0)).astype("int64")
        words = group["words"].to_numpy()
        saved = group["members"].to_numpy() * words - own * words
        place = {node: k for k, node in enumerate(group["node"])}
        above = [place[parent] if parent is not None else -1 for parent in group["parent"]]
        for k in range(len(group) - 1, 0, -1):
            leaves[above[k]] += leaves[k]
            saved[above[k]] += saved[k]
        least = group["least_of_all"].tolist()
        out = group[["node", "depth", "least_of_all", "n_convs", "n_children"]].copy()
        out["leaves"], out["saved"] = leaves, saved
        out["parent_least"] = pd.Series([least[k] if k >= 0 else None for k in above], dtype="Int64")
        return out

    return nodes.groupBy("shard").applyInPandas(add_up, schema)


def _end_hashes(nodes: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of the conversations that end at a node, least first, read shard by shard: a list of any length is hashed as it passes."""
    rows = nodes.where(F.size("ends") > 0).select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for now, _, ends in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                text = ",".join(map(str, ends)).encode()
                if now == node:
                    digest.update(b"," + text)
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = now, hashlib.sha256(text)
            yield packed(done)
        if node is not None:
            yield packed([(node, digest.hexdigest())])

    def packed(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node for node, _ in done], pa.binary()), pa.array([text for _, text in done], pa.string())], ["node", "ends_sha256"])

    return rows.mapInArrow(hashes, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv_id, place, said, words``; place -1 keeps a conversation without turns).

    Columns: ``node`` (a hash of the turns from the root), ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Each shard of conversations has its own index and trie; tries
    meet by the nodes' hashes, so a turn that all conversations share gives one row per shard, not per conversation.

    Places of a conversation are 0 and on without a gap. An empty table gives no row.
    """
    local = written(_shard_nodes(turns), "nodes")
    merged = local.groupBy("node").agg(F.first("parent").alias("parent"), F.min("least").alias("least_of_all"), F.sum("members").alias("n_convs"))
    merged = written(merged, "merged")
    children = merged.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    known = merged.drop("parent").join(children, "node", "left").na.fill(0, ["n_children"])
    sums = _subtree_sums(local.drop("ends").join(known, "node"))
    # The same in all shards: depth and what the whole trie says of a node.
    same = ["depth", "least_of_all", "n_convs", "n_children", "parent_least"]
    nodes = sums.groupBy("node").agg(*[F.max(name).alias(name) for name in same], F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return nodes.join(_end_hashes(local), "node", "left").select(
        "node",
        F.col("least_of_all").alias("conv_id"),
        "depth",
        F.col("parent_least").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )


def op13_prefix_trie(conversations: DataFrame) -> DataFrame:
    """The digest of the query: the trie of the rebuilt conversations. Null roles and texts are empty, other columns ignored."""
    turns = written(numbered_turns(conversations), "turns")
    return prefix_trie(rebuilt(turns)).drop("node")
