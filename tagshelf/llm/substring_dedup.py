"""Substring dedup of words by prefix-partitioned suffix trees.

A suffix is dealt out by its prefix up to and including its anchor (``anchors``), whose
length varies from one suffix to the next, so every subtree is small. Within a task the
subtrees grow level by level: a level splits nodes by the next word and drops the leaves,
which are nodes of one document. Nodes left at the depth of a window are internal nodes
of that depth or more; their repeats are maximal, since each start of a longer repeat
is a node of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .anchors import ROW, Alphabet, Spans, covered, packed, repeated_windows, rows_of, unpacked
from .common import ArrowFunction, by_value, giving_back

by_value(__name__)

# Words of an anchor.
GRAM = 4
# Words handled at once: a word takes more memory than a byte does.
BLOCK = 1 << 16


def drop_repeated_words(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) of each row of (doc_id, text).

    A word goes if it is covered by a window of ``window`` words whose sequence also starts
    in a document with a smaller ``doc_id``, judged on the input. ``spans`` are the maximal
    runs of words removed, as (start, end); ``kept`` is what stays, joined by one space, in
    UTF-8. Words are runs of other characters than ASCII white space.

    A NULL text has no words; texts shorter than a window lose none. Repeated rows are
    repeated, and rows of one id don't make each other lose words. A NULL ``doc_id`` is
    smaller than any other. ``doc_id`` is an integer. No rows give none; other columns
    are not read.
    """
    rows = rows_of(docs)
    shuffled = packed(rows)
    gone = repeated_windows(
        rows, shuffled, Alphabet(window, GRAM, word_hashes, word_pieces, BLOCK), _grown(window),
        whole=(F.col("n") > 1) & (F.col("doc") > F.col("least")),
        worth=(F.sum("n") > 1) & (F.min("first.doc") < F.max("first.doc")))
    schema = ("doc_id " + docs.schema["doc_id"].dataType.simpleString()
              + ", n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")
    return (shuffled.join(gone, "doc", "left").select(*ROW, "gone")
            .mapInArrow(_remover(window), schema))


def word_hashes(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def word_pieces(text: bytes, places: Sequence[tuple[int, int]]) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[a:b]) for a, b in places]


def _grown(window: int):
    return lambda spans: shared_windows(spans, window)


def shared_windows(spans: Spans, window: int) -> np.ndarray:
    """Which windows also start in a smaller document, by growing the subtrees to that depth."""
    number: dict[bytes, int] = {}
    texts = [[number.setdefault(w, len(number)) for w in text.split()] for text in spans.texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.fromiter((w for text in texts for w in text), np.int64, int(sizes.sum()))
    n = int(spans.windows.sum())
    owner = np.repeat(np.arange(len(texts)), spans.windows)
    within = np.arange(n) - (np.cumsum(spans.windows) - spans.windows)[owner]
    place = (np.cumsum(sizes) - sizes)[owner] + within
    least = spans.least[owner]
    # Suffixes whose anchor is the same and lies as deep share a subtree.
    node = spans.anchor[owner] << 32 | (spans.place[owner] - within)
    alive = np.arange(n)
    for depth in range(window + 1):
        _, node = np.unique(node, return_inverse=True)
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(low, node, least[alive])
        np.maximum.at(high, node, least[alive])
        branching = low[node] < high[node]
        alive, node = alive[branching], node[branching]
        if not len(alive) or depth == window:
            break
        node = node << 32 | words[place[alive] + depth]
    gone = np.zeros(n, bool)
    gone[alive] = least[alive] > low[node]
    return gone


def _remover(window: int) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, text in enumerate(unpacked(batch)):
                words = text.split()
                gone = covered(batch.column(4)[at], batch.column(2)[at], window, len(words))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if len(edges) else b" ".join(words)
                rows.append((len(words), int(gone.sum()), [{"start": a, "end": b} for a, b in edges.tolist()], kept))
            yield removal_batch(batch, rows, ["n_words", "n_removed", "spans", "kept"])
    return giving_back(run)


def removal_batch(batch: pa.RecordBatch, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()]
    columns = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays(
        [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", *names])
