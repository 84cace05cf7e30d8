"""Entries of several words in free text, against reading each text word by word."""

import random
import re
from collections import Counter

import pytest

from tagshelf.functions import spans
from tagshelf.operators import texts


def brute(rows, vocab):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    entries = {tuple(split(e)) for e in vocab} - {()}
    longest = max(map(len, entries), default=0)
    found = Counter()
    for key, text in rows:
        words, i = split(text), 0
        while i < len(words):
            n = next((n for n in range(longest, 0, -1) if tuple(words[i:i + n]) in entries and i + n <= len(words)), 0)
            if n:
                found[key, " ".join(words[i:i + n])] += 1
            i += max(1, n)
    return found


def matched(spark, rows, vocab, **options):
    frame = spark.createDataFrame(rows, "id int, text string")
    entries = spark.createDataFrame([(v,) for v in vocab], "word string")
    got = texts.match_vocabulary(frame, entries, ["id"], **options).collect()
    assert len({(r.id, r.word) for r in got}) == len(got)
    return Counter({(r.id, r.word): r["count"] for r in got})


RECIPE = "Heat the OLIVE-oil, add olives;\nolive oil and extra virgin olive oil. Salt, sea salt & salt!"


def test_longest_entry_first(spark):
    vocab = ["olive", "olive oil", "Extra virgin olive oil", "virgin olive", "salt", "sea  salt", None, "", "!"]
    got = matched(spark, [(1, RECIPE)], vocab)
    assert got == {(1, "olive oil"): 2, (1, "extra virgin olive oil"): 1, (1, "salt"): 2, (1, "sea salt"): 1}
    assert matched(spark, [(1, RECIPE)], ["olive", "olives"]) == {(1, "olive"): 3, (1, "olives"): 1}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": -1, "hot_rows": 5}])
def test_random_texts(spark, shuffled_joins, seed, options):
    draw = random.Random(seed)
    words = "a b c d É".split()
    phrase = lambda n: " ".join(draw.choice(words) for _ in range(n))
    vocab = [phrase(draw.randrange(1, 5)) for _ in range(12)]
    rows = [(draw.choice([None, 1, 2, 3]), draw.choice([None, "", phrase(draw.randrange(30))])) for _ in range(40)]
    rows += [rows[0]] * 2 + [(7, phrase(12))] * 3 + [(8, "a b " * 30_000)]
    assert matched(spark, rows, vocab, **options) == brute(rows, vocab)


def test_empty_tables(spark):
    assert not matched(spark, [], ["a b"]) and not matched(spark, [(1, "a b")], [])


def test_places_of_a_small_vocabulary_are_not_shuffled(spark):
    """A text is read within one task; only its counts go to others, whose rows do not grow with the places."""
    frame = spark.createDataFrame([(1, "a b " * 500)] * 2 + [(2, "c a")], "id int, text string").repartition(1)
    entries = spark.createDataFrame([("a b",), ("a",), ("b a b",)], "word string")
    got = texts.match_vocabulary(frame, entries, ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "a b", 1000), (2, "a", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_place" not in plan and "_ahead" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_texts_in_tiles(spark, monkeypatch, seed):
    """Batches cut within and between texts that are longer and shorter than a tile."""
    monkeypatch.setattr(spans, "TILE_WORDS", 5)
    draw = random.Random(seed)
    phrase = lambda n: " ".join(draw.choice("abcd") for _ in range(n))
    vocab = [phrase(draw.randrange(1, 5)) for _ in range(15)] + ["a b c d x"]
    rows = [(i // 2, phrase(draw.randrange(12))) for i in range(60)]
    assert matched(spark, rows, vocab) == brute(rows, vocab)
