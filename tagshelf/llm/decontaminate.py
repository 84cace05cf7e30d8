"""Benchmark decontamination: rare seeds of test items, then Smith-Waterman alignment.

An alignment that reaches the threshold matches a known share of an item's words, within a
stretch of the document of bounded length. However they are chosen, so many of the rarest
words of the item are among the matched ones. So a document is read once, and the places of
rare words of each item (seeds of one word: edits can break any longer one) tell which stretches
can hold a copy. These are aligned with the item; nothing that reaches the threshold is lost,
whatever the edits are and however many documents have it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ArrowFunction, by_value, fresh, giving_back, id_and_text, text_or_empty, texts_of

by_value(__name__)

WORD = r"[\p{L}\p{M}\p{N}]+"
# Items of fewer words than this have to be there as they are.
WHOLE = 3
MATCH, MISMATCH, GAP = 2, -1, -1
# The share of an item's best possible score from which a passage counts as a copy.
THRESHOLD = 0.5
# Characters of the items that documents are compared with in one pass; what is broadcast, and
# held by each task (about 30 bytes a character), grows with that.
ITEM_CHARS = 4 << 20
# Words of documents looked at together.
GROUP_WORDS = 1 << 16
# Alignments a task keeps at hand, for passages that stand in many documents.
KNOWN = 4096


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, start, end): the best passage of each document for each test item.

    ``score`` is the local alignment's, divided by the item's with itself, and is at least
    ``threshold`` (above 0); ``start`` and ``end`` count the document's words. Words are runs of
    letters and digits in lower case, so marks, case and line breaks don't matter. Of equal
    scores the first passage counts.

    Items of fewer than ``WHOLE`` words have to be there word by word, items without words
    match nothing. NULL texts and empty ones have no words. Repeated rows give one row, as do
    rows of one id; of items with one id the best counts. NULL ids are kept as they are.
    Without documents or items there are no rows.

    Items are gathered in blocks of ``ITEM_CHARS``, which are broadcast; there is one pass over the
    documents for each block, and no shuffle but for the rows found.
    """
    schema = (f"{_kind(docs, 'doc_id')}, {_kind(items, 'item_id')}, score double, start long, end long")
    passes = [id_and_text(docs).mapInArrow(_finder(index, threshold, to_arrow_type(items.schema["item_id"].dataType)), schema)
              for index in _indexes(items, threshold)]
    found = reduce(DataFrame.unionByName, passes) if passes else docs.sparkSession.createDataFrame([], schema)
    best = found.groupBy("doc_id", "item_id").agg(F.max_by(
        F.struct("score", "start", "end"), F.struct("score", -F.col("start"))).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without a passage of a test item, all columns as they are."""
    name = fresh(docs, "leaked")
    bad = leaks(docs, items, threshold).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


def _kind(df: DataFrame, column: str) -> str:
    return f"{column} {df.schema[column].dataType.simpleString()}"


# ---- seeds -----------------------------------------------------------------

class Index(NamedTuple):
    """The items of a block, and which of them each seed belongs to: those of ``seeds[word]``, i, are
    ``owners[offsets[i]:offsets[i + 1]]``. So many seeds (``needed``) of an item within so many words
    of a document (``width``) are what a copy has at least."""

    ids: list
    words: list[list[str]]
    places: list[dict[str, int]]
    seeds: dict[str, int]
    offsets: np.ndarray
    owners: np.ndarray
    needed: np.ndarray
    width: np.ndarray


def words_of(text: str) -> list[str]:
    return regex.findall(WORD, text.lower())


def places_of(words: Sequence[str]) -> dict[str, int]:
    """For each word a number whose bits are its places."""
    places: dict[str, int] = {}
    for i, word in enumerate(words):
        places[word] = places.get(word, 0) | 1 << i
    return places


def stretch(n: int, threshold: float) -> int:
    """Words of a document that an alignment with an item of ``n`` words covers, if it reaches the threshold.

    With m matches it has a score of MATCH * m less one for each word that is no match, so
    there are MATCH * (m - threshold * n) of these at most, and m is n at most.
    """
    return int(n * (1 + MATCH * (1 - threshold))) + 1


def least_matches(n: int, threshold: float) -> int:
    """Places of an item of ``n`` words that an alignment matches, if it reaches the threshold."""
    return max(1, math.ceil(threshold * n - 1e-9))


def rare_words(words: Sequence[str], frequency: Counter[str], threshold: float) -> tuple[set[str], int]:
    """The seeds of an item, and how many of their places a copy matches at least.

    A copy matches ``least`` places or more. All but ``least - needed`` of the item's places are seeds, the
    rarest words first, so ``needed`` of the matched ones are seeds.
    """
    if len(words) < WHOLE:
        return set(words), len(words)
    least = least_matches(len(words), threshold)
    needed = (least + 2) // 3
    ranked = sorted(words, key=lambda word: (frequency[word], word))
    return set(ranked[:len(words) - (least - needed)]), needed


def index_of(items: Sequence[tuple[object, list[str]]], frequency: Counter[str], threshold: float) -> Index:
    owners: dict[str, list[int]] = {}
    needed = []
    for at, (_, words) in enumerate(items):
        rare, n = rare_words(words, frequency, threshold)
        for word in rare:
            owners.setdefault(word, []).append(at)
        needed.append(n)
    sizes = [len(found) for found in owners.values()]
    widths = [stretch(len(words), threshold) for _, words in items]
    return Index([i for i, _ in items], [words for _, words in items], [places_of(words) for _, words in items],
                 {word: i for i, word in enumerate(owners)}, np.cumsum([0, *sizes]),
                 np.array([at for found in owners.values() for at in found], np.int64), np.array(needed), np.array(widths))


def _indexes(items: DataFrame, threshold: float) -> Iterator[Broadcast]:
    """The items in blocks, each an ``Index`` as a plain tuple: what is broadcast is read by name.

    Words are as rare as they are among the items of their block: which of them are seeds decides
    what is looked at and not what is found.
    """
    sent = items.sparkSession.sparkContext.broadcast
    block, chars = [], 0
    rows = items.select("item_id", text_or_empty().alias("text")).toLocalIterator()
    for row in rows:
        words = words_of(row["text"])
        if words:
            block.append((row["item_id"], words))
            chars += len(row["text"])
        if chars >= ITEM_CHARS:
            yield sent(tuple(index_of(block, _frequencies(block), threshold)))
            block, chars = [], 0
    if block:
        yield sent(tuple(index_of(block, _frequencies(block), threshold)))


def _frequencies(items: Sequence[tuple[object, list[str]]]) -> Counter[str]:
    return Counter(word for _, words in items for word in set(words))


def stretches(docs: Sequence[list[str]], index: Index) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, start, end): the stretches of some documents that can hold a copy, by their seeds."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    begins = np.cumsum(sizes) - sizes
    seeds = np.fromiter(map(index.seeds.get, chain.from_iterable(docs), repeat(-1)), np.int64, int(sizes.sum()))
    hits = np.flatnonzero(seeds >= 0)
    if not len(hits):
        return
    # Documents are laid out so far apart that no stretch reaches from one to the next.
    gap = int(index.width.max())
    doc = np.searchsorted(begins, hits, side="right") - 1
    hits, seed = hits + doc * gap, seeds[hits]
    counts = index.offsets[seed + 1] - index.offsets[seed]
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    item = index.owners[np.repeat(index.offsets[seed], counts) + within]
    place, doc = np.repeat(hits, counts), np.repeat(doc, counts)
    order = np.lexsort((place, item))
    item, place, doc = item[order], place[order], doc[order]
    # From each seed on, the last of as many as are needed.
    last = np.arange(len(item)) + index.needed[item] - 1
    there = last < len(item)
    last[~there] = 0
    at = np.flatnonzero(there & (item[last] == item) & (place[last] - place < index.width[item]))
    # A copy that has these seeds begins so late that it can reach the last, and ends so early
    # that it can have the first.
    doc, item, reach = doc[at], item[at], index.width[item[at]]
    origin = begins[doc] + doc * gap
    starts = np.maximum(0, place[last[at]] - reach + 1 - origin)
    ends = np.minimum(sizes[doc], place[at] + reach - origin)
    current = None
    for found in zip(doc.tolist(), item.tolist(), starts.tolist(), ends.tolist()):
        if current and current[:2] == found[:2] and found[2] <= current[3]:
            current = *current[:3], max(current[3], found[3])
            continue
        if current:
            yield current
        current = found
    if current:
        yield current


def matched_in_order(passage: Sequence[str], places: dict[str, int], n: int) -> int:
    """The most places of an item, of ``n`` words, that words of the passage match in order.

    The longest common subsequence, all places of the item at once as bits of a number.
    """
    full = (1 << n) - 1
    free = full
    for place in map(places.get, passage):
        if place:
            held = free & place
            free = (free + held | free - held) & full
    return n - free.bit_count()


def _groups(texts: Iterator[bytes]) -> Iterator[tuple[int, list[list[str]]]]:
    """The words of documents, of about ``GROUP_WORDS`` at a time, and the number of the first."""
    docs, size, first = [], 0, 0
    for text in texts:
        docs.append(words_of(text.decode()))
        size += len(docs[-1])
        if size >= GROUP_WORDS:
            yield first, docs
            docs, size, first = [], 0, first + len(docs)
    if docs:
        yield first, docs


def _finder(sent: Broadcast, threshold: float, kind: pa.DataType) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*sent.value)
        least = [least_matches(len(words), threshold) for words in index.words]
        known: dict[tuple[int, str], tuple[int, int, int]] = {}
        for batch in batches:
            places, rows = [], []
            for first, docs in _groups(texts_of(batch)):
                for at, item, a, b in stretches(docs, index):
                    passage, wanted = docs[at][a:b], index.words[item]
                    if matched_in_order(passage, index.places[item], len(wanted)) < least[item]:
                        continue
                    key = item, " ".join(passage)
                    if key not in known:
                        if len(known) >= KNOWN:
                            known.clear()
                        known[key] = align_parts(passage, wanted, threshold if len(wanted) >= WHOLE else 1.0)
                    score, start, end = known[key]
                    best = MATCH * len(wanted)
                    if score and score >= (threshold if len(wanted) >= WHOLE else 1.0) * best:
                        places.append(first + at)
                        rows.append((index.ids[item], score / best, a + start, a + end))
            ids, scores, starts, ends = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places, pa.int64())), pa.array(ids, kind), pa.array(scores, pa.float64()),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["doc_id", "item_id", "score", "start", "end"])
    return giving_back(run)


# ---- alignment -------------------------------------------------------------

def align(passage: list[str], item: list[str]) -> tuple[int, int, int]:
    """The best local alignment of words: its score, and the start and end in the passage.

    Smith-Waterman with a linear gap cost, a row of the passage at a time; gaps within a row
    are resolved by a running maximum.
    """
    number: dict[str, int] = {}
    p = np.fromiter((number.setdefault(w, len(number)) for w in passage), np.int64, len(passage))
    q = np.fromiter((number.setdefault(w, len(number)) for w in item), np.int64, len(item))
    slope = -GAP * np.arange(len(q) + 1)
    above, since = np.zeros(len(q) + 1, np.int64), np.zeros(len(q) + 1, np.int64)
    best = (0, 0, 0)
    for i in range(len(p)):
        diagonal = np.zeros(len(q) + 1, np.int64)
        diagonal[1:] = above[:-1] + np.where(q == p[i], MATCH, MISMATCH)
        start = np.full(len(q) + 1, i)
        start[1:] = np.where(above[:-1] > 0, since[:-1], i)
        down = above + GAP
        start = np.where(down > diagonal, since, start)
        row = np.maximum(np.maximum(diagonal, down), 0)
        # row[j] = max over k <= j of row[k] - (j - k) * gap
        raised = row + slope
        run = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == run, np.arange(len(run)), 0))
        row, start = run - slope, start[source]
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), int(start[top]), i + 1)
        above, since = row, start
    return best


def promising(passage: list[str], item: list[str], threshold: float) -> list[tuple[int, int]]:
    """The parts of the passage outside of which no alignment reaches ``threshold``.

    An alignment that does lies in a stretch of bounded length, whose words match so many places
    of the item.
    """
    width, least = stretch(len(item), threshold), threshold * len(item)
    # Of each word of the item, how many places are not matched by the words in the window.
    free = Counter(item)
    matched = 0
    parts: list[tuple[int, int]] = []
    for end, word in enumerate(passage):
        if word in free:
            matched += free[word] > 0
            free[word] -= 1
        start = end + 1 - width
        if start > 0:
            gone = passage[start - 1]
            if gone in free:
                free[gone] += 1
                matched -= free[gone] > 0
        if matched >= least:
            a, b = max(0, start), end + 1
            if parts and a <= parts[-1][1]:
                parts[-1] = (parts[-1][0], b)
            else:
                parts.append((a, b))
    return parts


def align_parts(passage: list[str], item: list[str], threshold: float) -> tuple[int, int, int]:
    """``align``, if the score reaches ``threshold``; anything less else. Of equal scores the first."""
    best, places = (0, 0, 0), places_of(item)
    for a, b in promising(passage, item, threshold):
        if matched_in_order(passage[a:b], places, len(item)) < threshold * len(item):
            continue
        score, start, end = align(passage[a:b], item)
        if score > best[0]:
            best = (score, a + start, a + end)
    return best
