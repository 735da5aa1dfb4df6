"""The trie of rebuilt conversations against one of plain dictionaries."""

import hashlib
import random
import re
import zlib

from tillwatch.llm import prefix_trie, queries
from tillwatch.llm.common import table

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def remainder(number, by):
    """Towards zero, as SQL has it."""
    return number - int(number / by) * by


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    # equal turns: by the hash that the operator orders them by
    said = lambda row: hashlib.md5(f"{len(row[2])}:{row[2]}{row[3]}".encode()).digest()
    turns = {conv: [row[2:] for row in sorted(kept, key=lambda row: (row[:2], said(row)))] for conv, kept in own.items()}
    whole = {}
    for conv, kept in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        whole[conv] = turns.get(conv - remainder(conv, 20), [])[:h] + kept[h:]
    return whole


def expected(rows):
    whole = rebuilt(rows)
    members = {}
    for conv, turns in whole.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children, leaves, saved = {}, {}, {}
    for prefix in members:
        if prefix:
            children[prefix[:-1]] = children.get(prefix[:-1], 0) + 1
    for prefix, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        for depth in range(len(prefix) + 1):
            above = prefix[:depth]
            saved[above] = saved.get(above, 0) + (len(convs) - 1) * words
            leaves[above] = leaves.get(above, 0) + (prefix not in children)
    found = []
    for prefix, convs in members.items():
        ends = ",".join(str(conv) for conv in sorted(convs) if len(whole[conv]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        found.append((min(convs), len(prefix), parent, len(convs), children.get(prefix, 0), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def found(frame):
    return sorted((tuple(row[name] for name in COLUMNS) for row in frame.collect()), key=repr)


def test_trie_of_the_table(spark, sf_dir):
    rows = [tuple(row) for row in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_prefix_trie(spark, sf_dir)) == expected(rows)


def test_conversations_over_several_shards(spark):
    """Shared starts across shards, negative and far ids, null turns, equal turns, empty and blank texts, ids without a row at their base."""
    draw = random.Random(5)
    texts = ["Hi there", "", None, " \t", "a b  c", "long " * 3000]
    rows = []
    for conv in [*range(-45, 45), *range(1020, 1030), *range(4090, 4130), 1 << 40, (1 << 40) + 3]:
        if conv % 7:
            rows += [(conv, draw.choice([turn, turn, None, 0]), draw.choice(["user", "assistant", None]), draw.choice(texts)) for turn in range(draw.randrange(1, 6))]
    frame = spark.createDataFrame([(*row, "x", 0) for row in rows] + [(None, 0, "user", "left out", "x", 0)], f"{ROWS}, said string, place long")
    assert found(prefix_trie.op13_prefix_trie(frame)) == expected(rows)


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    # 21 takes two turns of 20, which is not there, and has only one of its own
    lonely = next(conv for conv in range(21, 40) if zlib.crc32(str(conv).encode()) % 4 >= 2)
    rows = [(lonely, 0, "user", "a b"), (3, 0, "user", "c")]
    result = found(prefix_trie.op13_prefix_trie(spark.createDataFrame(rows, ROWS)))
    assert result == expected(rows)
    assert any(row[1] == 0 and row[3] == 2 for row in result)


def test_many_copies_of_one_long_conversation(spark):
    rows = [(conv, turn, "user", f"turn {turn} {'same' if conv % 3 else conv}") for conv in range(60) for turn in range(300)]
    assert found(prefix_trie.op13_prefix_trie(spark.createDataFrame(rows, ROWS))) == expected(rows)


def test_no_conversations(spark):
    assert found(prefix_trie.op13_prefix_trie(spark.createDataFrame([], ROWS))) == []
