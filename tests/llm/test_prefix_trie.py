"""Tries of conversations against a plain one, with shards, stretches and queues of a few nodes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import prefix_trie as trie
from tallyweave.llm.catalog import QUERIES


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain_turns(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [x[3:] for x in sorted(own)] for c, own in found.items()}


def plain_rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members, children = defaultdict(list), defaultdict(set)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
            if d:
                children[tuple(own[: d - 1])].add(tuple(own[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
    out = []
    for node, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else -(10**9)
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(node), parent, len(own), len(children[node]), leaves[node], saved[node], sha))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(-(10**9) if x is None else x for x in row) for row in df.collect())


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = ("id", "conv", "depth", "digest", "parent", "copies", "n_chars", "shard", "part", "source", "children")
    return df.select("*", *(F.lit(7).alias(x) for x in clashing))


def drawn(seed, convs, longest, texts=3):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-150, 700), convs):
        for turn in range(draw.randint(1, longest)):
            rows.append((c, draw.choice([turn, turn, turn, None]), draw.choice(["user", "bot", None]), draw.choice(["", "é日", "long text", None][:texts])))
    return rows


ROWS = drawn(1, 60, 12) + [(5, 0, "user", "x")] * 3 + [(None, 0, "user", "x"), (None, None, None, None)]
DEEP = [(c, t, "u", "a" if t < 30 - c else f"b{c}") for c in range(6) for t in range(32)] + [(c, 0, "u", "a") for c in range(50, 90)]


@pytest.mark.parametrize(
    "sweep", [trie.Sweep(), trie.Sweep(shard_nodes=5, block=3, queue=2), trie.Sweep(queue=6), trie.Sweep(shard_nodes=0, block=1, queue=1)]
)
@pytest.mark.parametrize("rows", [ROWS, DEEP], ids=["drawn", "deep"])
def test_equal_to_a_plain_trie(spark, rows, sweep):
    own = trie.turns(frame(spark, rows), "conv_id", "turn", "role", "text")
    found = trie.prefix_trie(own, own.select("conv").distinct(), sweep)
    assert rows_of(found) == plain_trie(plain_turns(rows))


def test_query_rebuilds_openings(spark, tmp_path):
    frame(spark, ROWS + drawn(2, 300, 7, texts=4)).write.parquet(f"{tmp_path}/conversations.parquet")
    found = rows_of(QUERIES["op13_prefix_trie"](spark, str(tmp_path)))
    assert found == plain_trie(plain_rebuilt(plain_turns(ROWS + drawn(2, 300, 7, texts=4))))
    # some are left without turns: the root has members that end there
    assert [x[7] for x in found if x[1] == 0] != [hashlib.sha256(b"").hexdigest()]


def test_empty_tables_and_conversations_without_turns(spark):
    own = trie.turns(frame(spark, []), "conv_id", "turn", "role", "text")
    assert trie.prefix_trie(own, own.select("conv").distinct()).count() == 0
    convs = spark.createDataFrame([(3,), (12,)], "conv long")
    assert rows_of(trie.prefix_trie(own, convs)) == plain_trie({3: [], 12: []})


def test_conversations_cut_by_tasks(spark):
    """One conversation lies in many tasks, and its ids are those of the whole sequence."""
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = [(7, t, "u", f"t{t % 5}") for t in range(3000)] + [(8, t, "u", f"t{t % 5}") for t in range(2000)] + [(9, 0, "u", "t0")] * 500
        own = trie.turns(frame(spark, rows), "conv_id", "turn", "role", "text")
        scanned = trie._scanned(own)
        assert trie._continued(trie._scanned(own).limit(0).collect()) == {}
        ids = {(r["conv"], r["depth"]): (bytes(r["id"]), bytes(r["parent"]), bytes(r["opening"])) for r in scanned.collect()}
        assert len(ids) == 5500 and scanned.select("part").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    for conv, texts in plain_turns(rows).items():
        value = 1
        for depth, (role, text) in enumerate(texts, 1):
            parent, value = value, (value * trie._BASE + int.from_bytes(digest(role, text), "big")) % trie._PRIME
            own_id = ids[conv, depth]
            assert own_id[:2] == (value.to_bytes(16, "big"), parent.to_bytes(16, "big")) and own_id[2] == ids[conv, 1][0]


def test_queue_gives_up_what_is_needed_last():
    queue = trie.TotalsQueue(4)
    pushed = [(5, b"b"), (5, b"a"), (4, b"c"), (3, b"d"), (5, b"a"), (2, b"e")]
    spilled = [x for depth, node in pushed for x in queue.push(depth, node, (1, 1, 2))]
    assert sorted(spilled) == [(2, b"e", 1, 1, 2), (3, b"d", 1, 1, 2), (4, b"c", 1, 1, 2)]
    assert queue.pop(5, b"a") == [2, 2, 4] and queue.pop(5, b"aa") == [0, 0, 0] and queue.pop(5, b"b") == [1, 1, 2]
