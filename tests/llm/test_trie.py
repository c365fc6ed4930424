"""Conversation trie against a plain version."""

import collections
import hashlib
import math
import random
import zlib

import pytest

from flowlark.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, node string, last long, `a.b` long"


def plain_trie(rows):
    """Nodes of rows (conv, turn, role, text)."""
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            who, said = (role or "").encode(), (text or "").encode()
            digest = hashlib.sha256(b"%d:" % len(who) + who + said).digest()
            turns[conv].append((turn is not None, turn or 0, digest, who, said))
    own = {c: [x[3:] for x in sorted(found)] for c, found in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members = collections.defaultdict(list)
    for c, said in rebuilt.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, who in members.items():
        gain = (len(who) - 1) * len(n[-1][1]) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += gain
    out = []
    for n, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(rebuilt[c]) == len(n))
        over = min(members[n[:-1]]) if n else None
        out.append((min(who), len(n), over, len(who), children[n], leaves[n], saved[n],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes(df, **options):
    found = trie.prefix_trie(*trie.rebuild(trie.turn_digests(df)), **options)
    return sorted(map(tuple, found.select(COLUMNS).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


EDGES = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "hi"), (0, None, None, None), (0, 1, "assistant", "hi"),
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", ""), (2, 0, "", "userhello"),
    (3, 5, "user", "é中\U0001f600"), (3, 5, "user", "b"), (3, 5, "assistant", "b"),
    (None, 0, "user", "lost"), (None, None, None, None), (7, 0, "us", "erhello"), (8, 0, "use", "rhello"),
    (-3, 0, "user", "minus"), (-1, 0, "user", "minus"), (-5, 1, "user", "five"), (-5, 0, None, "x"),
    (11, 0, "user", "long " * 50_000), (12, 0, "user", "long " * 50_000), (10, 0, "user", "long " * 50_000),
    (9223372036854775807, 0, "user", "hello"),
]


@pytest.mark.parametrize("shard_rows", [trie.SHARD_ROWS, 3, 0])
def test_edges(spark, shard_rows):
    assert nodes(table(spark, EDGES), shard_rows=shard_rows) == plain_trie(EDGES)


def test_empty_and_single(spark):
    assert nodes(table(spark, EDGES).filter("false")) == []
    assert nodes(table(spark, EDGES[11:13])) == []
    assert nodes(table(spark, EDGES[:1])) == plain_trie(EDGES[:1])


@pytest.mark.parametrize("shard_rows", [trie.SHARD_ROWS, 50])
def test_hot_prefix_and_long_conversation(spark, shard_rows):
    """A third of the conversations are equal, one has a third of the turns."""
    pick = random.Random(5)
    rows = [(c, t, "user", f"same {t}") for c in range(400) if c % 3 == 0 for t in range(6)]
    rows += [(c, t, "user", pick.choice("abc")) for c in range(400) if c % 3 for t in range(pick.randint(1, 9))]
    rows += [(c, t, "user", f"turn {t}") for c in (1000, 2003) for t in range(1200)]
    assert nodes(table(spark, rows), shard_rows=shard_rows) == plain_trie(rows)


def test_whole_table(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = plain_trie([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert nodes(turns) == want
    assert nodes(turns, shard_rows=10) == want


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_IDS", 3)
    convs = spark.createDataFrame([(c, 0) for c in range(-20, 30)], "conv long, last long")
    empty = spark.createDataFrame([], "conv long, pos long, sha binary, bytes long, last long")
    got = trie.prefix_trie(convs, empty).collect()
    want = hashlib.sha256(",".join(map(str, range(-20, 30))).encode()).hexdigest()
    assert [(r.n_convs, r.n_leaves, r.ends_sha256) for r in got] == [(50, 1, want)]


def test_spilling_queue():
    pick = random.Random(3)
    queue, plain, got, want = trie.SpillingQueue(held=10, runs=4), [], [], []
    for step in range(4000):
        if plain and pick.random() < 0.4:
            plain.sort()
            want.append(plain.pop(0))
            assert queue.peek() == want[-1]
            got.append(queue.pop())
        else:
            entry = (pick.randint(0, 500), bytes([pick.randint(0, 255)]), step)
            queue.push(entry)
            plain.append(entry)
        assert len(queue.heap) <= 10 and len(queue.heads) <= 5
    while (entry := queue.peek()) is not None:
        got.append(queue.pop())
    assert got == want + sorted(plain)
