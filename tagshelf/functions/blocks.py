"""What a task does with one Arrow batch of embeddings and a block of query vectors."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle

# Tasks get these functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Queries multiplied with one Arrow batch at a time.
QUERY_TILE = 256


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def block_scorer(sent: Broadcast, k: int, digits: int,
                 names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidates of each Arrow batch (key, embedding) for the broadcast queries."""

    def scorer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = sent.value
        least = np.full(len(queries), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            # In key order, so that of equals the first ones are the ones to keep.
            batch = batch.take(pc.sort_indices(batch.column(0), null_placement="at_start"))
            numbers = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
            units = unit_rows(numbers.reshape(batch.num_rows, -1))
            for start in range(0, len(queries), QUERY_TILE):
                tile = slice(start, start + QUERY_TILE)
                query, product, similarity = _best_of(queries[tile] @ units.T, least[tile], k, digits)
                if len(query):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(query + start)), batch.column(0).take(pa.array(product)),
                         pa.array(similarity)], names=list(names))

    return scorer


def cluster_scorer(sent: Broadcast, k: int, digits: int,
                   names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidates of each Arrow batch (key, embedding, cluster) for the queries listed for its clusters.

    What is sent: names of the queries, their unit vectors, per cluster the places of the queries to
    compare, and per query a similarity that ``k`` products are known to reach.
    """

    def scorer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, lists, known = sent.value
        least = known.copy()
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.take(pc.sort_indices(batch.column(0), null_placement="at_start"))
            clusters = batch.column(2).to_numpy(zero_copy_only=False)
            numbers = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
            units = unit_rows(numbers.reshape(batch.num_rows, -1))
            for cluster in np.unique(clusters):
                rows, wanted = np.flatnonzero(clusters == cluster), lists[int(cluster)]
                for start in range(0, len(wanted), QUERY_TILE):
                    tile = wanted[start:start + QUERY_TILE]
                    reached = least[tile]
                    query, product, similarity = _best_of(queries[tile] @ units[rows].T, reached, k, digits)
                    least[tile] = reached
                    if len(query):
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(tile[query])), batch.column(0).take(pa.array(rows[product])),
                             pa.array(similarity)], names=list(names))

    return scorer


def _best_of(similarity: np.ndarray, least: np.ndarray, k: int,
             digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates of one batch: row, column and rounded value of at most ``k`` entries per row.

    ``least`` holds, per row, the ``k``-th value of an earlier batch. What is
    below it cannot be among the best, so only the first batches are ranked in
    full. It is raised in place.
    """
    wanted = similarity >= (least - 10.0 ** -digits)[:, None]
    many = np.flatnonzero(wanted.sum(axis=1) > k)
    if many.size:
        rounded = np.round(similarity[many], digits)
        kth = np.partition(rounded, rounded.shape[1] - k, axis=1)[:, -k]
        wanted[many] = _first_best(rounded, kth[:, None], k)
        least[many] = np.maximum(least[many], kth)
    row, column = np.nonzero(wanted)
    return row, column, np.round(similarity[row, column], digits) + 0.0


def _first_best(values: np.ndarray, kth: np.ndarray, k: int) -> np.ndarray:
    """Marks the ``k`` greatest of each row, ``kth`` being the least of them; of equals, the left ones."""
    above, level = values > kth, values == kth
    open_places = k - above.sum(axis=1, keepdims=True)
    return above | (level & (np.cumsum(level, axis=1) <= open_places))
