"""The prefix trie against dictionaries on the driver, and its double arrays by themselves."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tuneframe.llm import trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def by_brute_force(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, code, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in sorted(own.items()):
        h = zlib.crc32(str(c).encode()) % 4
        made = (own.get(c - c % 20, [])[:h] if c >= 0 or c % 20 == 0 else own.get(-(-c // 20) * 20, [])[:h]) + turns[h:]
        for d in range(len(made) + 1):
            members[tuple(made[:d])].append(c)
        ends[tuple(made)].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    digest = lambda p: hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], digest(p)) for p, m in members.items()), key=repr
    )


def conversations(n=300, seed=1):
    """Few distinct turns, so that prefixes are shared; many copies, ties, nulls, gaps and one very long conversation."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 37 == 5:
            continue
        for turn in range(rnd.randrange(1, 9) if c % 3 else 5):
            text = f"turn {turn} of\tall" if c % 3 == 0 else rnd.choice(["a b", "b", "", "c d e", None])
            rows.append((c, rnd.choice([turn, turn, 0, None]) if c % 11 == 0 else turn, rnd.choice(["user", "user", None]) if c % 7 == 0 else "user", text))
    rows += [(1000, i, "user", f"long {i % 50}") for i in range(400)] + [(1020, i, "user", f"long {i % 50}") for i in range(400)]
    rows += [(c, i, "user", f"long {i % 50}") for c in (1001, 1002, 1003) for i in range(300)]
    rows += [(None, 0, "user", "of no conversation"), (-3, 0, "user", "a"), (-20, 0, "user", "b"), (-20, 1, "user", "c"), (7, 3, "user", "again"), (7, 3, "user", "again")]
    rnd.shuffle(rows)
    return rows


def test_nodes(spark):
    rows = conversations()
    made = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert sorted(map(tuple, made.collect()), key=repr) == by_brute_force(rows)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_any_number_of_shards(spark, shards, monkeypatch):
    rows = [r for r in conversations(120, seed=shards) if (r[0] or 0) < 1000]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(shards))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        made = sorted(map(tuple, trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert made == by_brute_force(rows)


def test_a_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "JOINED", 7)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 4000, 20) for t in range(3)] + [(c, 0, "user", f"x{c}") for c in range(1, 200, 2)]
    made = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(9))
    assert sorted(map(tuple, made.collect()), key=repr) == by_brute_force(rows)


def test_turnless_and_empty(spark):
    one = spark.createDataFrame([(22, 0, "user", "gone")], SCHEMA)  # starts with turns that conversation 20 does not have
    assert zlib.crc32(b"22") % 4 > 0
    assert [tuple(r) for r in trie.prefix_trie(one).collect()] == by_brute_force([(22, 0, "user", "gone")]) == [(22, 0, None, 1, 0, 1, 0, hashlib.sha256(b"22").hexdigest())]
    assert trie.prefix_trie(one.limit(0)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_other_names_and_clashing_columns(spark):
    rows = [(20 * i, t, "r", f"w {i % 2} {t}") for i in range(6) for t in range(2)]
    odd = spark.createDataFrame([(*r, "s", "k", 1) for r in rows], "`my id` long, at long, who string, said string, same string, key string, conv_id int")
    made = trie.prefix_trie(odd, conv="my id", turn="at", role="who", text="said")
    assert made.columns[0] == "my id" and sorted(map(tuple, made.collect()), key=repr) == by_brute_force(rows)


@pytest.mark.parametrize("seed", range(4))
def test_double_array(seed):
    rnd = np.random.default_rng(seed)
    wide = [3, 40, 500, 4000][seed]
    sequences = sorted({tuple(rnd.integers(0, wide, rnd.integers(0, 7))) for _ in range(3000)} | {tuple(range(wide))} | {(i,) for i in range(wide)})
    made, levels = trie.build([np.array(s, np.int64) for s in sequences])
    nodes = {s[:d] for s in sequences for d in range(1, len(s) + 1)}
    places = np.concatenate(levels)
    assert len(places) == len(nodes) == len(set(places.tolist())) and sorted(np.flatnonzero(made.check[1:] >= 0) + 1) == sorted(places)
    found = {}
    for node in sorted(nodes, key=len):
        found[node] = int(made.step(np.array([found.get(node[:-1], 0)]), np.array([node[-1]]))[0])
        assert found[node] > 0
    assert len(set(found.values())) == len(nodes)
    absent = [(node, label) for node in list(nodes)[:500] for label in rnd.integers(0, wide, 3) if (*node, label) not in nodes]
    assert all(made.step(np.array([found[node]]), np.array([label]))[0] == -1 for node, label in absent)
    assert made.top < 3 * len(nodes) + wide  # packed
