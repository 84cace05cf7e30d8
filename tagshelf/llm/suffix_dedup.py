"""Suffix-array dedup of bytes, sorting suffixes by a difference cover.

Spans of text that can hold a repeated string (``anchors``) are dealt out by content over
the tasks. Each task sorts the suffixes of its spans: the triples at places 1 and 2 modulo
3 are sorted and named, names that are not unique yet are sorted by recursion, the
remaining suffixes are merged in by their first symbols and the rank of what follows, and
neighbours in the order have their prefixes compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import ROW, Alphabet, Spans, covered, mixed, packed, repeated_windows, rows_of, unpacked
from .common import ArrowFunction, by_value, giving_back
from .substring_dedup import removal_batch

by_value(__name__)

# Bytes of an anchor.
GRAM = 32
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def drop_repeated_bytes(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of each row of (doc_id, text).

    A byte of the text's UTF-8 goes if it is covered by a string of ``length`` bytes that also
    starts anywhere else, in the same document or another, judged on the input. ``spans``
    are the maximal runs removed, as (start, end); ``kept`` is what stays.

    A NULL text has no bytes; shorter texts than ``length`` lose none. Repeated rows are
    copies of each other like any other documents. A NULL ``doc_id`` is like any other;
    ``doc_id`` is an integer. No rows give none; other columns are not read.
    """
    rows = rows_of(docs)
    shuffled = packed(rows)
    gone = repeated_windows(
        rows, shuffled, Alphabet(length, GRAM, byte_hashes, byte_pieces), _sorted(length),
        whole=(F.col("n") > 1) & (F.col("doc") >= F.col("least")),
        worth=(F.min("n") == 1) & F.max("first.doc").isNotNull())
    schema = ("doc_id " + docs.schema["doc_id"].dataType.simpleString()
              + ", n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")
    return (shuffled.join(gone, "doc", "left").select(*ROW, "gone")
            .mapInArrow(_remover(length), schema))


def byte_hashes(text: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(text, np.uint8)]


def byte_pieces(text: bytes, places: Sequence[tuple[int, int]]) -> list[bytes]:
    return [text[a:b] for a, b in places]


def _sorted(length: int):
    return lambda spans: repeated_starts(spans, length)


def repeated_starts(spans: Spans, length: int) -> np.ndarray:
    """Which windows of the spans are found in another span too."""
    joined = np.frombuffer(b"\0".join(spans.texts) + b"\0", np.uint8)
    sizes = np.fromiter(map(len, spans.texts), np.int64, len(spans.texts)) + 1
    n = int(spans.windows.sum())
    owner = np.repeat(np.arange(len(sizes)), spans.windows)
    within = np.arange(n) - (np.cumsum(spans.windows) - spans.windows)[owner]
    place = (np.cumsum(sizes) - sizes)[owner] + within
    order = np.argsort(suffix_ranks(joined.astype(np.int64) + 1)[place])
    same = equal_prefixes(joined, place[order][:-1], place[order][1:], length)
    gone = np.zeros(n, bool)
    gone[order[:-1][same]] = True
    gone[order[1:][same]] = True
    return gone


def equal_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each of ``a`` are those from ``b``."""
    eights = np.lib.stride_tricks.sliding_window_view(text, 8).copy().view(np.uint64).ravel()
    alive = np.arange(len(a))
    for at in (*range(0, length - 7, 8), *([length - 8] if length % 8 else [])):
        alive = alive[eights[a[alive] + at] == eights[b[alive] + at]]
    same = np.zeros(len(a), bool)
    same[alive] = True
    return same


def names_of(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense names of sorted order, from 1, and how many there are."""
    order = np.argsort(keys, kind="stable")
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(new)
    return names, int(new.sum())


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """The rank of each suffix of ``text`` (integers from 1), by the difference cover {1, 2} modulo 3."""
    n = len(text)
    if n < 4:
        order = sorted(range(n), key=lambda i: text[i:].tolist())
        ranks = np.empty(n, np.int64)
        ranks[order] = np.arange(n)
        return ranks
    t = np.concatenate((text, np.zeros(5, np.int64)))
    base = int(t.max()) + 1
    # The place behind the end counts as one of the cover if it keeps the two classes apart.
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    cover = np.concatenate((ones, twos))
    if base ** 3 < 2 ** 62:
        keys = (t[cover] * base + t[cover + 1]) * base + t[cover + 2]
    else:
        pairs, _ = names_of(t[cover] * base + t[cover + 1])
        keys = pairs * base + t[cover + 2]
    names, different = names_of(keys)
    if different < len(cover):
        names = suffix_ranks(names) + 1
    # rank[i] is that of the suffix at i among the cover's; 0 behind the end.
    rank = np.zeros(n + 5, np.int64)
    rank[cover] = names
    rank[n:] = 0
    wide = len(cover) + 2
    rest = np.arange(0, n, 3)
    short = t[:n] * wide + rank[1:n + 1]
    rest = rest[np.argsort(short[rest], kind="stable")]
    pair, _ = names_of(t[:n] * base + t[1:n + 1])
    long = pair * wide + rank[2:n + 2]
    inside = cover[cover < n]
    inside = inside[np.argsort(rank[inside])]
    first, second = inside[inside % 3 == 1], inside[inside % 3 == 2]
    out = np.empty(n, np.int64)
    out[rest] = (np.arange(len(rest)) + np.searchsorted(short[first], short[rest])
                 + np.searchsorted(long[second], long[rest]))
    place = np.empty(n, np.int64)
    place[inside] = np.arange(len(inside))
    out[first] = place[first] + np.searchsorted(short[rest], short[first])
    out[second] = place[second] + np.searchsorted(long[rest], long[second])
    return out


def _remover(length: int) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, text in enumerate(unpacked(batch)):
                if not batch.column(4)[at].is_valid:
                    rows.append((len(text), 0, [], text))
                    continue
                gone = covered(batch.column(4)[at], batch.column(2)[at], length, len(text))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                rows.append((len(text), int(gone.sum()), [{"start": a, "end": b} for a, b in edges.tolist()], kept))
            yield removal_batch(batch, rows, ["n_bytes", "n_removed", "spans", "kept"])
    return giving_back(run)
