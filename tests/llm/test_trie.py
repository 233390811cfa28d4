"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from casecurve.llm import prefix_trie as t
from casecurve.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def turns_by_hand(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [x[2:] for x in sorted(of)] for conv, of in found.items()}


def regrown_by_hand(convs):
    out = {}
    for conv, turns in convs.items():
        h = zlib.crc32(str(conv).encode()) % 6
        out[conv] = convs.get(conv - int(math.fmod(conv, 100)), [])[:h] + turns[h:]
    return out


def trie_by_hand(convs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(conv)
    done, out = {}, Counter()
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        leaves = sum(done[k][0] for k in kids) or 1
        saved = sum(done[k][1] for k in kids) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        done[node] = leaves, saved
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out[min(members[node]), len(node), parent, len(members[node]), len(kids), leaves, saved, digest] += 1
    return out


def odd_turns(seed=4):
    rng = random.Random(seed)
    say = ["yes", "no", "", "Ünder 中文", "tell me more", "a\x1fb", None]
    rows = []
    for conv in [*range(-210, -190), *range(0, 40), *range(100, 160), *range(305, 320)]:
        rows += [(conv, turn, rng.choice(["user", "assistant"]), rng.choice(say)) for turn in range(rng.randint(0, 7))]
    rows += [(conv, turn, "user", f"the same {turn}") for conv in range(1000, 1120) for turn in range(5)]  # copies
    rows += [(2000 + i, 0, "system", "one first turn") for i in range(90)]
    rows += [(2000 + i, 1, "user", f"each its own {i}") for i in range(60)]
    rows += [(7, None, "user", "no number"), (7, None, None, None), (7, 3, None, "again"), (7, 3, None, "again")]
    rows += [(None, 1, "user", "of no conversation"), (3000, 0, "user", "long " * 30000), (3001, -5, "", "")]
    rows += [(4000, i, "user", f"turn {i}") for i in range(300)]  # deeper than a cut splitter
    rows += [(4001, i, "user", f"turn {i}") for i in range(301)]
    rng.shuffle(rows)
    return rows


def test_registered_query(spark, tmp_path):
    rows = odd_turns()
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(str(tmp_path / "conversations.parquet"))
    got = Counter(map(tuple, QUERIES["op12_prefix_trie"](spark, str(tmp_path)).collect()))
    assert got == trie_by_hand(regrown_by_hand(turns_by_hand(rows)))


@pytest.mark.parametrize(("shards", "nodes"), [(1, 64), (2, 4), (13, 40), (200, 1 << 18)])
def test_any_cut_gives_the_same_trie(spark, shards, nodes, monkeypatch):
    monkeypatch.setattr(t, "_BLOCK", 7)
    rows = odd_turns(shards)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "1 AS pos", "2 AS h1", "3 AS path", "4 AS chars")
    got = Counter(map(tuple, t.prefix_trie(t.turn_lists(df), shards, nodes).collect()))
    assert got == trie_by_hand(turns_by_hand(rows))


def test_copies_are_spread_over_shards(spark):
    """Half of all conversations are the same; no shard gets much more than its share."""
    rows = [(i, turn, "user", "same" if i % 2 else f"own {i}") for i in range(4000) for turn in range(3)]
    lists = t.turn_lists(spark.createDataFrame(rows, SCHEMA))
    paths = lists.select("conv", F.flatten(F.transform("turns", lambda x: F.array(x["h1"], x["h2"]))).alias("path"))
    skeleton = t.skeleton_of(paths, 16)
    dealt = paths.mapInArrow(lambda b: t._dealt(b, skeleton.splitters), "shard int, conv long, path array<long>")
    sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 4000 / 16


def test_turnless_and_empty(spark):
    lists = t.turn_lists(spark.createDataFrame([(5, 0, "user", "hi")], SCHEMA))
    none = lists.select("conv", F.slice("turns", 1, 0).alias("turns"))
    assert Counter(map(tuple, t.prefix_trie(none).collect())) == trie_by_hand({5: []})
    assert t.prefix_trie(lists.filter("conv < 0")).collect() == []
