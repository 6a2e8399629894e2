"""The trie of conversation prefixes, against plain Python over whole conversations."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from topicpulse.llm import conversation_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - int(math.fmod(c, 5))  # the remainder has the sign of the id, as in SQL
        whole = tuple(turns.get(head, [])[:h] + own[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += children[node] == 0
    return sorted(
        (
            min(own), len(n), min(members[n[:-1]]) if n else -1, len(own), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n, own in members.items()
    )


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clashing = frame.select("*", *[F.lit("x").alias(c) for c in ("k1", "p1", "i", "pos", "depth", "at", "part")])
    out = trie.prefix_trie(clashing)
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())


def talks(seed):
    draw = random.Random(seed)
    texts = ["", None, "é", "yes", "no", "a longer text of some words"]
    rows = []
    for conv in range(40):
        for turn in range(draw.choice([1, 1, 2, 5, 9, 14])):
            rows.append((conv * draw.choice([1, 1, 2]), turn, draw.choice(["user", "bot", None]), draw.choice(texts)))
    rows += [(500 + n, t, "user", "same") for n in range(60) for t in range(3)]  # copies
    rows += [(901, None, "user", "first"), (901, 0, None, None), (901, 0, None, None), (None, 1, "user", "x")]
    # Conversations that take no turn from their head and lose all of their own.
    rows += [(1000 + n, 0, "user", "lost") for n in range(1, 5)] + [(-7, 0, "user", "x"), (-5, 0, "user", "y")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_are_those_of_whole_conversations(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(trie, "CHUNK", 2)
        monkeypatch.setattr(trie, "IDS", 8)
    rows = talks(seed)
    assert found(spark, rows) == plain(rows)


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    rows = [(5, t, "user", str(t)) for t in range(400)] + [(10, t, "user", str(t)) for t in range(300)]
    rounds = []
    once = trie._contract
    monkeypatch.setattr(trie, "_contract", lambda live, parts: rounds.append(1) or once(live, parts))
    assert found(spark, rows) == plain(rows)
    assert len(rounds) <= 14


def test_one_long_text_and_no_conversation(spark):
    rows = [(5, 0, "user", "x" * 200_000), (6, 0, "user", None)]
    assert found(spark, rows) == plain(rows)
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
