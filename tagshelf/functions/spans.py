"""What a task does with matches of a text that may overlap."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle

# Tasks get these functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words looked at together, or those of one text that has more.
TILE_WORDS = 256 * 1024


class Phrases(NamedTuple):
    """Entries of words by their beginnings: ``levels`` has one table per number of words.

    A beginning of n words is known by its place in the n-th table. That holds, in order, the place
    of the beginning without its last word times the number of ``words``, plus the last word's place
    in these; and beside it the place of the entry that has no more words, or -1.
    """

    words: pa.Array
    entries: pa.Array
    levels: list[tuple[np.ndarray, np.ndarray]]


def phrase_levels(entries: pa.Array) -> Phrases:
    """``entries`` are distinct, each of words with a blank between them."""
    split = pc.split_pattern(entries, " ")
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    node = np.zeros(len(entries), np.int64)
    levels, open_ = [], np.arange(len(entries))
    for n in range(int(sizes.max(initial=0))):
        open_ = open_[sizes[open_] > n]
        keys, node[open_] = np.unique(node[open_] * len(coded.dictionary) + places[starts[open_] + n], return_inverse=True)
        ends = np.full(len(keys), -1, np.int64)
        last = open_[sizes[open_] == n + 1]
        ends[node[last]] = last
        levels.append((keys, ends))
    return Phrases(coded.dictionary, entries, levels)


def phrase_counts(sent: Broadcast, names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How often each entry is taken in each text, read from its start, the longest first.

    Rows are (words, keys...); what comes back has the keys, the entry and its count.
    """

    def run(batches):
        phrases = sent.value
        for batch in batches:
            sizes = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
            behind = np.cumsum(sizes, dtype=np.int64)
            a = 0
            while a < batch.num_rows:
                before = behind[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(behind, before + TILE_WORDS, "right")))
                tile = batch.slice(a, b - a)
                row, entry, count = counts_taken(tile.column(0).flatten(), sizes[a:b], phrases)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*(column.take(row) for column in tile.columns[1:]), phrases.entries.take(pa.array(entry)),
                     pa.array(count)], list(names))
                a = b

    return run


def counts_taken(words: pa.Array, sizes: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, entry, count) of texts with ``sizes`` words each, that stand one behind the other in ``words``."""
    places = pc.fill_null(pc.index_in(words, value_set=phrases.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    left = np.cumsum(sizes)[text] - np.arange(len(text))
    at, node = np.flatnonzero(places >= 0), 0
    length, entry = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    for n, (keys, ends) in enumerate(phrases.levels):
        wanted = node * len(phrases.words) + places[at + n]
        node = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        known = keys[node] == wanted
        at, node = at[known], node[known]
        ended = ends[node] >= 0
        length[at[ended]], entry[at[ended]] = n + 1, ends[node[ended]]
        more = left[at] > n + 1
        at, node = at[more], node[more]
        more = places[at + n + 1] >= 0
        at, node = at[more], node[more]
    found = np.flatnonzero(length)
    # A match ends within its text, so the next one that is taken can be told over all texts.
    after, i, taken = np.searchsorted(found, found + length[found]).tolist(), 0, []
    while i < len(after):
        taken.append(i)
        i = after[i]
    found = found[taken]
    pairs, count = np.unique(text[found] * max(1, len(phrases.entries)) + entry[found], return_counts=True)
    row, entry = np.divmod(pairs, max(1, len(phrases.entries)))
    return row, entry, count.astype(np.int64)


def without_overlaps(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The matches left if a text is read from its start and each match taken skips what it covers.

    Rows are (text id, place, length, ...), those of a text together and ordered by place, longer
    ones first. A match that stands there twice, as for a text that does, is taken twice.
    """

    def run(batches):
        text, place, length = None, -1, 0
        for batch in batches:
            taken = np.zeros(batch.num_rows, bool)
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if row[0] != text:
                    text, place, length = row[0], -1, 0
                if row[1] >= place + length or row[1:] == (place, length):
                    taken[i] = True
                    place, length = row[1:]
            left = batch.filter(pa.array(taken))
            yield pa.RecordBatch.from_arrays([left.column(left.schema.get_field_index(n)) for n in names], list(names))

    return run
