"""The prefix trie against a plain computation, its queue, and the odd cases."""

import hashlib
import random
import zlib

import pytest

from tidemark.llm import conversation_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def slow_rebuilt(rows):
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = original.get(c - c % 20, [])[:h] + own[h:]
    return out


def slow_trie(conversations):
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        words = len(node[-1][1].encode().split()) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in below)
    rows = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(conversations[c]) == len(node))
        rows.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids.get(node, [])),
                     leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()))


def test_query_equals_plain_computation(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_conversation_prefix_trie(spark, folder)) == slow_trie(slow_rebuilt(rows))


@pytest.mark.parametrize(("heavy", "band"), [(3, 2), (4, 3), (1000, 4), (2, 1000)])
def test_shards_of_any_size(spark, monkeypatch, heavy, band):
    """Small shards, so that there are several levels of them."""
    monkeypatch.setattr(conversation_trie.math, "isqrt", lambda n: 0)
    rng = random.Random(heavy * 100 + band)
    conversations = {}
    for c in range(60):
        start = list(rng.choice(list(conversations.values()))) if conversations and rng.random() < 0.7 else []
        start = start[: rng.randint(0, len(start))] if rng.random() < 0.8 else start
        conversations[c] = start + [("user", rng.choice("ab") * rng.randint(0, 2) + " w") for _ in range(rng.randint(0, 9))]
    conversations[70] = []
    conversations[71] = [("x", f"t {i}") for i in range(40)]
    conversations[72] = conversations[71][:20]
    rows = [(c, i, *t, "clash") for c, ts in conversations.items() for i, t in enumerate(ts)]
    turns = conversation_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    members = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    assert found(conversation_trie.prefix_trie(turns, members, heavy, band)) == slow_trie(conversations)


def test_odd_rows(spark):
    rows = [(1, None, None, None, "x"), (1, 0, "user", "", "x"), (1, 0, "user", "", "x"), (1, 0, "a", "b c", "x"),
            (None, 0, "user", "lost", "x"), (20, 3, "user", "word " * 40000, "x"), (20, 2, "user", "  é", "x"),
            (21, 0, "q", "r", "x"), (25, 0, "q", "r", "x"), (-3, 0, "q", "r s", "x"), (-20, 1, None, "r\ts", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    turns, members = conversation_trie.rebuilt_conversations(conversation_trie.numbered_turns(docs))
    expected = {}
    for c, ts in slow_rebuilt(rows).items():
        expected[c] = ts
    # c % 20 of a negative number is negative in SQL
    plain = {c: [t[2:] for t in sorted((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == c)]
             for c in {r[0] for r in rows} - {None}}
    for c in (-3, -20):
        h = zlib.crc32(str(c).encode()) % 4
        expected[c] = plain.get(0 if c == -3 else -20, [])[:h] + plain[c][h:]
    assert found(conversation_trie.prefix_trie(turns, members)) == slow_trie(expected)
    nothing = docs.where("conv_id > 99")
    turns, members = conversation_trie.rebuilt_conversations(conversation_trie.numbered_turns(nothing))
    assert found(conversation_trie.prefix_trie(turns, members)) == []


def test_a_conversation_over_many_blocks(spark):
    """A third of all rows in one conversation: its turns are numbered and summed in several tasks."""
    rows = [(7, i // 3, "user", f"same {i % 3}", "x") for i in range(400)] + [(c, 0, "u", "t", "x") for c in range(100, 900)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns, members = conversation_trie.rebuilt_conversations(conversation_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA)))
        assert found(conversation_trie.prefix_trie(turns, members, band=64)) == slow_trie(slow_rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_queue_gives_entries_in_order():
    rng = random.Random(1)
    queue, expected = conversation_trie.SpillingQueue(limit=5), []
    for _ in range(300):
        entry = tuple(rng.randint(-9, 9) for _ in range(6))
        queue.push(entry)
        expected.append(entry)
    taken = []
    while queue.first() is not None:
        assert queue.first() == (entry := queue.pop())
        taken.append(entry)
    assert taken == sorted(expected)
