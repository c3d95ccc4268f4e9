import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, x int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:]
    return out


def brute_force(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        kids = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in under)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        ends = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(cs), len(p), parent, len(cs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted(map(tuple, prefixtrie.prefix_nodes(df, **options).collect()), key=repr)


def some_rows(seed, n, longest, words):
    random = np.random.default_rng(seed)
    return [
        (int(c), int(t), ["user", "assistant"][t % 2], str(random.choice(words)))
        for c in random.permutation(n) for t in range(random.integers(0, longest + 1))
    ]


@pytest.mark.parametrize("seed,n,longest,words", [(1, 60, 4, ["a", "bé"]), (2, 40, 20, ["x"]), (3, 50, 12, ["x", "x", "x", "x", "yy"])])
def test_equals_brute_force(spark, seed, n, longest, words):
    rows = some_rows(seed, n, longest, words)
    assert found(frame(spark, rows)) == brute_force(rows)


def test_many_batches_and_shuffled_look_ups(spark, monkeypatch):
    """One batch or eight, look-ups by broadcast or with copied nodes: the same trie."""
    rows = some_rows(4, 50, 9, ["x", "x", "y"])
    expected = brute_force(rows)
    assert found(frame(spark, rows), batches=(1,)) == expected
    monkeypatch.setattr(prefixtrie, "BROADCAST_NODES", 0)
    monkeypatch.setattr(prefixtrie, "COPIED_NODES", 5)
    assert found(frame(spark, rows), batches=(1, 1, 2, 4)) == expected


def test_exit_nodes(spark):
    """What the fat binary search finds is the longest prefix on the trie."""
    rows = some_rows(5, 120, 14, ["x", "x", "x", "y"])
    convs, _ = prefixtrie.rebuilt(frame(spark, rows))
    first = convs.filter("conv_id % 2 = 0").groupBy("x", "y").agg(F.min("conv_id").alias("conv_id"))
    longest = convs.agg(F.max("len")).first()[0]
    nodes, _, n = prefixtrie.trie(convs.join(first.select("conv_id"), "conv_id", "left_semi"), longest, (1,))
    located = prefixtrie.exits(convs.select("conv_id", "len", "xs", "ys", "cs"), nodes, n, longest).collect()
    texts = rebuilt(rows)
    known = {tuple(t[:d]) for c, t in texts.items() if c % 2 == 0 for d in range(len(t) + 1)}
    assert {r["conv_id"]: r["follows"] for r in located} == {
        c: max(d for d in range(len(t) + 1) if tuple(t[:d]) in known) for c, t in texts.items()
    }


@pytest.mark.parametrize("a,b", [(0, 1), (0, 7), (4, 7), (5, 6), (7, 12), (0, 64), (63, 65), (100, 127)])
def test_two_fattest(spark, a, b):
    got = spark.range(1).selectExpr(f"{a} a", f"{b} b").select(prefixtrie.two_fattest("a", "b")).first()[0]
    assert got == max(range(a + 1, b + 1), key=lambda n: n & -n)


def test_messy_rows(spark):
    long = "word " * 30_000
    rows = [
        (0, None, "user", None), (0, 0, None, "hi"), (0, 0, None, "hi"), (0, 1, "user", long), (1, 0, "", "hi"), (1, 0, "", "hi"),
        (2, 5, "user", long), (None, 0, "user", "lost"), (-3, 1, "user", "a"), (-5, 1, "user", "b"), (-5, 2, "user", "b"), (7, 0, "user", "alone"),
        (2**63 - 1, 0, "user", "last"), (-(2**63), 0, "user", "first"),
    ] + [(c, t, "user", "same") for c in (10, 11, 12, 13, 14) for t in range(9)]
    assert found(frame(spark, rows)) == brute_force(rows)


def test_empty_and_turnless(spark):
    assert found(frame(spark, []).limit(0)) == []
    turnless = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(turnless, 0, "user", "gone")]
    assert found(frame(spark, rows)) == brute_force(rows)
    assert found(frame(spark, rows))[0][:6] == (turnless, 0, None, 1, 0, 1)


def test_no_cross_join_and_hot_prefix_folds_early(spark):
    rows = frame(spark, some_rows(6, 30, 5, ["x"]))
    plan = prefixtrie.prefix_nodes(rows)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
