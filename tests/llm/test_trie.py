import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlake.llm import prefix_trie
from leadlake.llm.common import scratch
from tests.llm import frames

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(some)] for c, some in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, some in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(own.get(donor, [])[:h] + some[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    out = []
    for node, some in members.items():
        below = [n for n in members if n[: len(node)] == node]
        joined = ",".join(map(str, sorted(ends[node])))
        out.append(
            (
                min(some),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(some),
                children[node],
                sum(children[n] == 0 for n in below),
                sum((len(members[n]) - 1) * len(WORD.findall(n[-1][1])) for n in below if n),
                hashlib.sha256(joined.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def frame(spark, rows):
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return made.select("*", *[F.lit("other").alias(c) for c in (*frames.CLASHING, "depth", "parent", "digest", "words", "h", "part")])


def got(spark, rows, parts=None, **settings):
    chats = frame(spark, rows)
    with scratch(spark) as keep:
        return frames.rows(prefix_trie.trie(chats, keep, prefix_trie.Settings(**settings)), *COLUMNS)


def chats(seed, n=150, longest=9):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-40, 400), n):
        for k in range(rng.choice([1, 1, 2, 3, longest])):
            few = 2 if rng.random() < 0.8 else 9
            rows.append((c, rng.choice([k, k, None, 0]), rng.choice(["user", "assistant"]), f"text {rng.randrange(few)} of\tit"))
    return rows


@pytest.mark.parametrize("engine", [{}, {"shard_rows": 10}, {"shard_rows": 40, "band": 2}, {"shard_rows": 15, "band": 3}])
def test_trie_equals_brute_force(spark, engine):
    rows = chats(1)
    assert got(spark, rows, **engine) == brute(rows)


def test_edge_rows(spark):
    long = frames.prose(1, 20_000)
    rows = [
        (0, 1, "user", "a b"), (0, 1, "user", "a b"), (0, None, None, None), (1, None, "", ""), (2, 5, "user", long),
        (None, 1, "user", "no one's"), (3, 0, "x:y", "z"), (3, 1, "x", ":yz"), (-1, 0, "user", "é 東京"), (-21, 0, None, " \t\n"),
        (2**60 + 3, 0, "user", "a b"), (2**60, 0, "user", "far"), (40, 0, "user", "one turn only"), (59, 0, "user", "taken away"),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []


def test_one_long_conversation_in_many_tasks_and_bands(spark):
    """A conversation of most rows: it is cut between tasks, and deep subtrees are added up band by band."""
    rows = [(7, k, "user", f"turn {k % 3}") for k in range(400)] + [(c, k, "user", f"turn {k % 3}") for c in range(40, 46) for k in range(c)]
    chats = frame(spark, rows)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with scratch(spark) as keep:
            own = prefix_trie.own_prefixes(prefix_trie.turn_digests(chats), keep).collect()
            for conv in (7, 40, 45):
                some = sorted((r.pos, r.value) for r in own if r.conv_id == conv)
                total, expected = 0, []
                for pos in range(1, len(some) + 1):
                    number = prefix_trie._number(digest("user", f"turn {(pos - 1) % 3}"))
                    total = (total + number * pow(prefix_trie.BASE, pos, prefix_trie.PRIME)) % prefix_trie.PRIME
                    expected.append((pos, prefix_trie._key(total)))
                assert [(p, bytes(v)) for p, v in some] == expected
        assert got(spark, rows, band=5, shard_rows=50) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_many_conversations_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "JOINED", 7)
    rows = [(20 * c, k, "user", f"the same {k}") for c in range(300) for k in range(5)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 50, 20_000])
def test_slots_are_minimal_perfect_and_verified(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
    table = prefix_trie.SlotTable(high, low)
    assert sorted(table.slots(high, low).tolist()) == list(range(n))
    assert (table.slots(high ^ np.uint64(1), low) == -1).all()
    assert sum(places for places, *_ in table.levels) < 4 * n + 10


@pytest.mark.parametrize("shards", [1, 64])
def test_colliding_digests_stop_the_job(spark, shards):
    """Two prefixes of one key, in one shard and in two."""
    kinds = "conv_id long, depth long, key binary, parent binary, digest binary, words long, ends boolean"
    key, parent = b"k" * 16, prefix_trie.ROOT
    for other in ((2, key, parent, b"a"), (1, key, b"p" * 16, b"a"), (1, key, parent, b"b")):
        depth, key, parent_key, turn = other
        rows = [(c, 1, key, parent, b"a", 1, True) for c in range(5)] + [(9, depth, key, parent_key, turn, 1, True)]
        paths = spark.createDataFrame([(*r[:2], *(bytearray(x) for x in r[2:5]), *r[5:]) for r in rows], kinds)
        with pytest.raises(Exception, match="one digest"):
            prefix_trie.node_counts(paths, shards, prefix_trie.Settings()).collect()
