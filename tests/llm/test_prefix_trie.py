"""The prefix trie against a trie made node by node."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tagshelf.llm import prefix_trie


def brute(told, names):
    """Rows of the trie of ``told`` (conv_id to its turns)."""
    paths = {c: tuple(told.get(c, ())) for c in names}
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    rows = []
    for node, convs in members.items():
        below = [p for p in members if p[:len(node)] == node]
        rows.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node],
                     sum(p not in children for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                     hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return Counter(rows)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("block", [1, 2, 4])
def test_random_conversations(spark, block):
    draw = random.Random(block)
    told = {c: [(draw.choice("ua"), draw.choice(["", "x", "yé", "long text"])) for _ in range(draw.choice([0, 1, 3, 4, 5, 8, 11]))]
            for c in draw.sample(range(-50, 1000), 120)}
    for c in list(told)[::3]:
        told[c] = told[list(told)[0]][:draw.randrange(9)] + told[c][:2]
    rows = [(c, i, *t) for c, turns in told.items() for i, t in enumerate(turns)]
    draw.shuffle(rows)
    convs = spark.createDataFrame([(c,) for c in told for _ in range(2)], "conv_id long")
    got = prefix_trie.prefix_trie(table(spark, rows), convs, block)
    assert Counter(map(tuple, got.collect())) == brute(told, told)


def test_a_large_group_ends_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LISTED", 7)
    told = {c: [("u", "hello"), ("a", "world")] for c in range(300)} | {300: [("u", "hello")], 301: [("u", "hello\n")]}
    got = prefix_trie.prefix_trie(table(spark, [(c, i, *t) for c, turns in told.items() for i, t in enumerate(turns)]))
    assert Counter(map(tuple, got.collect())) == brute(told, told)


def test_edges(spark):
    rows = [(1, None, None, "first"), (1, 0, "u", None), (1, 0, "u", None), (None, 0, "u", "lost"), (2, 5, "", "first"),
            (2, 6, "u", ""), (3, 0, "u", "x" * 200_000)]
    told = {1: [("", "first"), ("u", ""), ("u", "")], 2: [("", "first"), ("u", "")], 3: [("u", "x" * 200_000)], 4: []}
    frame = table(spark, rows).selectExpr("*", "1 as id", "2 as k", "3 as depth", "4 as said")
    convs = spark.createDataFrame([(4,), (None,), (1,)], "conv_id long")
    assert Counter(map(tuple, prefix_trie.prefix_trie(frame, convs).collect())) == brute(told, told)
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0
    alone = prefix_trie.prefix_trie(frame.limit(0), convs).collect()
    assert [tuple(r)[:7] for r in alone] == [(1, 0, None, 2, 0, 1, 0)]
