"""Prefix tries against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from riskloom.llm import prefix_trie

TURNS = "conv_id long, turn int, role string, text string, path string, key string, part int"


def sequences(rows):
    """conv_id -> list of (role, text) in the order of the operator."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            out[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in out.items()}


def regenerated(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = seqs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(seqs):
    """Every node as the tuple of the operator's columns."""
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    out = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(inside) if len(seqs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(inside), len(node), parent, len(inside), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], TURNS)


def got(df):
    return sorted((tuple(r[c] for c in prefix_trie.COLUMNS) for r in df.collect()), key=repr)


def talk(seed, convs, words=3, most=7):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, most)):
            rows.append((c * 3 + rng.randrange(3), t, rng.choice(["user", "bot", None]), rng.choice(["é" * k for k in range(words)] + [None])))
    return rows


@pytest.mark.parametrize("items", [4, 40, prefix_trie.SHARD_ITEMS])
def test_nodes_equal_brute_force_for_any_shard_size(spark, items):
    rows = talk(items, 60)
    table = prefix_trie.paths(frame(spark, rows))
    seqs = sequences(rows)
    assert got(prefix_trie.trie(table, items)) == brute(seqs)
    assert got(prefix_trie.trie(prefix_trie.rebuilt(table), items)) == brute(regenerated(seqs))


def test_many_copies_of_one_conversation_and_ties(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)]
    rows += [(c, t, "user", f"turn {t}") for c in range(300, 310) for t in range(2)]
    rows += [(400, 1, "a", "x"), (400, 1, "b", "y"), (400, 1, "a", "x"), (400, None, None, None), (401, 0, "a:", "b"), (402, 0, "a", ":b")]
    rows += [(None, 0, "user", "lost"), (-7, 0, "user", "")]
    assert got(prefix_trie.trie(prefix_trie.paths(frame(spark, rows)), 50)) == brute(sequences(rows))


def test_a_very_long_conversation_and_an_empty_table(spark):
    rows = [(1, t, "user", "a" * (t % 5)) for t in range(600)] + [(2, t, "user", "a" * (t % 5)) for t in range(599)]
    nodes = got(prefix_trie.prefix_trie(frame(spark, rows)))
    assert len(nodes) == 601 and max(n[1] for n in nodes) == 600
    assert next(n for n in nodes if n[1] == 0)[6] == sum(t % 5 for t in range(599))
    assert prefix_trie.prefix_trie(frame(spark, [])).count() == 0


def test_turnless_conversations_end_on_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 40) if c % 5]
    seqs = regenerated(sequences(rows))
    assert [] in seqs.values()
    assert got(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(frame(spark, rows))))) == brute(seqs)


def test_tree_is_balanced_by_medians():
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.median_order(1023):
        tree.insert([i])
    deepest, todo = 0, [(tree.down[0], 1)]
    while todo:
        node, d = todo.pop()
        if node:
            deepest = max(deepest, d)
            todo += [(tree.low[node], d + 1), (tree.high[node], d + 1)]
    assert deepest == 10
    assert [tree.symbol[n] for n in tree.walk()] == [-1, *range(1023)]
