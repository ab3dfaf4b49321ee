"""The trie of conversations against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from feedloom.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, position long, id string, size string, block int, key long"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def conversations(rng, n, longest, vocabulary):
    rows = []
    for c in rng.sample(range(-20, 4 * n), n):
        length = rng.choice([0, 1, 2, 3, 5, 8, longest])
        turns = [(rng.choice(["user", None, ""]), rng.choice(vocabulary)) for _ in range(length)]
        if rng.random() < 0.4 and rows:
            turns = [r[2:] for r in rows if r[0] == rows[-1][0]][: rng.randint(1, 60)] + turns[: rng.randint(0, 3)]
        numbers = [None, *range(len(turns) - 1)] if rng.random() < 0.2 else range(10, 10 + len(turns))
        rows += [(c, t, *x) for t, x in zip(numbers, turns, strict=False)]
    return rows


def run(spark, monkeypatch, rows):
    frame = spark.createDataFrame([(*r, 1, "a", "b", 2, 3) for r in rows], SCHEMA)
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: frame)
    return queries.conversation_trie(spark, "")


@pytest.mark.parametrize("seed, width, longest", [(1, 32, 70), (2, 4, 30), (3, 2, 9)])
def test_trie_equals_brute_force(spark, make, monkeypatch, seed, width, longest):
    monkeypatch.setattr(prefix_trie, "WIDTH", width)
    rng = random.Random(seed)
    rows = conversations(rng, 120, longest, ["a", "é", None, "", "long text"])
    rows += [(None, 0, "user", "nobody's")] + [(c, t, "user", "copy") for c in range(1000, 1080) for t in range(12)]
    got = run(spark, monkeypatch, rows)
    assert got.columns == ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(str(tuple(r)) for r in got.select(names).collect()) == brute(rows)


def test_no_conversation(spark, make, monkeypatch):
    assert run(spark, monkeypatch, []).count() == 0
    assert run(spark, monkeypatch, [(None, 1, "user", "x")]).count() == 0


def test_one_conversation_without_turns(spark, make, monkeypatch):
    h = zlib.crc32(b"1") % 9
    assert h > 1
    (only,) = run(spark, monkeypatch, [(1, 0, "user", "cut off")]).collect()
    assert (only.conv_id, only.depth, only.parent_conv_id, only.n_convs, only.n_children, only.n_leaves, only.saved_tokens) == (1, 0, None, 1, 0, 1, 0)
    assert only.ends_sha256 == hashlib.sha256(b"1").hexdigest()
