"""Hard negatives against all inner products in plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagshelf.llm import negatives


def brute(rows, every=50, k=5, n=3):
    used = [(i, v, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, _, va, la in (r for r in used if r[0] % every == 0):
        near = sorted((-dot(va, v), i) for i, _, v, label in used if label == la and i != a)[:k]
        for ps, p in near:
            ps = -ps
            fit = sorted((-dot(va, v), i) for i, _, v, label in used if label != la
                         and 50 * ps <= 100 * dot(va, v) <= 95 * ps)[:n]
            out += [(a, p, rank + 1, i, ps, -s) for rank, (s, i) in enumerate(fit)]
    return Counter(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("score", F.lit(0))
    frame = frame.withColumn("vector", F.lit("")).withColumn("slot", F.lit(1))
    return Counter(map(tuple, negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, **options).collect()))


def random_rows(seed, n=300, width=6, spread=1.0):
    draw = random.Random(seed)
    rows = [(i, [draw.gauss(0.2, 1) * spread for _ in range(width)], draw.randrange(3)) for i in range(n)]
    return [(i, rows[0][1] if i % 4 == 1 else v, label) for i, v, label in rows]      # many ties


@pytest.mark.parametrize("block", [None, 2])
def test_random_vectors_with_ties(spark, block, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_TILE", 17)
    monkeypatch.setattr(negatives, "ANCHOR_TILE", 3)
    rows = random_rows(1)
    assert mined(spark, rows, block=block) == brute(rows)


def test_wide_numbers_need_python_integers(spark):
    rows = random_rows(2, 120, 3, 3e6)
    assert mined(spark, rows) == brute(rows)


def test_edges(spark):
    v = [0.5, 0.25]
    rows = [*random_rows(3, 200, 2), (0, v, 1), (0, v, 1), (200, v, 0), (200, v, 1), (201, v[:1], 0), (202, [], 0), (203, None, 0),
            (204, [None, 1.0], 0), (205, [math.nan, 1.0], 1), (206, [math.inf, 1.0], 1), (207, v, None), (None, v, 1),
            (250, [], 2), (300, [1.0], 0)]
    assert mined(spark, rows) == brute(rows)
    assert not mined(spark, [])
    assert not mined(spark, [(0, v, 1), (1, v, 1)])
    assert not mined(spark, [(0, None, 1)])


@pytest.mark.parametrize("spread", [3, 1000, 2 ** 25, 2 ** 40])
def test_packed_products(spread):
    draw = np.random.default_rng(spread)
    for rows, width in ((1, 1), (5, 3), (130, 64)):
        a = draw.integers(-spread, spread + 1, (7, width))
        c = draw.integers(-spread, spread + 1, (rows, width))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in c] for p in a]
        assert negatives.scores(a, c).tolist() == want
