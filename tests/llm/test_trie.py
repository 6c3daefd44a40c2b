"""Prefix trie against a plain-Python version."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import trie
from quarry.llm.common import Scratch


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            d = sha(f"{len(role)}:{role}{text}")
            signed = [int.from_bytes(bytes.fromhex(d[i:i + 16]), "big", signed=True) for i in (0, 16)]
            convs[conv_id].append((turn is not None, turn or 0, *signed, role, text))
    turns = {c: [t[-2:] for t in sorted(ts)] for c, ts in convs.items()}
    members = defaultdict(list)
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    out = set()
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        childless = [q for q in below if not any(r[:len(q)] == q and len(r) == len(q) + 1 for r in below)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(cs) if made[c] == p)
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids), len(childless), saved, sha(ends)))
    return out


def data():
    rnd = random.Random(11)
    rows = []
    for c in [*range(0, 60), *range(100, 130), 205, 309, -7, -100, -205]:
        kind = rnd.random()
        said = [("user", "hi"), ("assistant", "hello there")] if kind < 0.5 else []
        said += [(rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a", "b", None, "", "东京🙂"])) for _ in range(rnd.randrange(5))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(said)]
    hot = [(c, i, "user", f"same {i}") for c in range(400, 460) for i in range(7)]           # copies of one conversation
    long_ = [(501, i, "user", f"turn {i}") for i in range(300)] + [(500, 0, "user", "x" * 50_000)]
    odd = [(601, None, "user", "no turn"), (601, 1, "user", "b"), (601, 1, "user", "a"), (601, 1, "user", "a"), (None, 0, "user", "nobody")]
    rows += hot + long_ + odd
    rnd.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, k string").repartition(3)
    with Scratch(spark, "t") as s:
        return [tuple(r) for r in trie.prefix_trie(df, s).collect()]


@pytest.mark.parametrize(("part", "factor", "shard", "ids"), [(1_000, 1_000, 10_000, 512), (2, 3, 20, 2), (1, 2, 7, 1)])
def test_trie_against_brute_force(spark, monkeypatch, part, factor, shard, ids):
    for name, value in (("PART", part), ("FACTOR", factor), ("SHARD", shard), ("BLOCK_IDS", ids)):
        monkeypatch.setattr(trie, name, value)
    rows = data()
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == expected(rows)


def test_empty_table_and_turnless_conversation(spark):
    assert run(spark, []) == []
    # the only turns of 101 are those that its absent base replaces: it stays a member of the root
    only = [(101, i, "user", str(i)) for i in range(zlib.crc32(b"101") % 6)]
    assert only and run(spark, only) == [(101, 0, None, 1, 0, 1, 0, sha("101"))]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 20_000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(-(1 << 63), (1 << 63) - 1, n) for _ in range(2))
    t = trie.NodeTable(a, b)
    assert sorted(t.slots(a, b).tolist()) == list(range(n))
    assert (t.slots(a, b + 1) == -1).all() and (t.slots(b, a) == -1).sum() >= n - 1


def test_equal_digests_are_refused():
    same = np.array([5, 6, 5]), np.array([1, 2, 1])
    with pytest.raises(ValueError):
        trie.NodeTable(*same)


def test_a_collision_of_digests_is_found(spark):
    rows = [(1, 1, 7, 7, 0, 0, 3, 3, 1, 1), (2, 1, 7, 7, 0, 0, 3, 4, 1, 1)]
    members = spark.createDataFrame(rows, "conv_id long, depth long, p1 long, p2 long, q1 long, q2 long, d1 long, d2 long, chars long, total long")
    with pytest.raises(Exception, match="share a digest"):
        trie.nodes_of(members).collect()
