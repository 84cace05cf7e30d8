"""Hard-negative mining by exact integer inner products of Kronecker-packed vectors.

Components are made integers. Those of several candidates, biased so that none is negative,
stand in separated fields of one wide integer, and an anchor's component, biased as well,
multiplies them all at once. The sum over the components keeps the fields apart, since each
is as wide as its greatest possible sum; what the biases added is known and taken off again.

The stated set of anchors is compared with all rows, in blocks of anchors: a task meets each
batch of its rows with the block, twice. The first time it hands on the anchors' best positives,
the second time the best negatives of each of these.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize, scratch_path
from .common import ArrowFunction, by_value

by_value(__name__)

# Bytes of anchor vectors compared in one pass over all rows; the most that is broadcast.
BLOCK_BYTES = 16 * 1024 * 1024
# Candidates and anchors multiplied at a time in a task: bounds the scores it holds.
ROW_TILE = 2048
ANCHOR_TILE = 256
# Bits of a machine word, and of integers that may be added up in one with room to spare.
WORD_BITS = 64
SAFE_BITS = 62


def usable(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part; ``vector`` is scaled, not yet floored.

    Rows without an id, a label or a vector, or with a component that is NULL or, once it
    is scaled, not finite, don't.
    """
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    taken = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        scaled.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return taken.filter("vec_id is not null and label is not null and vector is not null").filter(finite)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   least: Fraction = Fraction(1, 2), most: Fraction = Fraction(19, 20), scale: int = 256,
                   block: int | None = None) -> DataFrame:
    """Negatives nearly as close to an anchor as one of its positives, of (vec_id, embedding, label).

    Scores are inner products of the floored components, as whole numbers; higher ones come
    first, ties go by smaller ``vec_id``. The positives of an anchor (a row that satisfies
    ``is_anchor``, a condition on ``vec_id``) are its first ``positives`` rows of the same label
    with another id. For each the first ``negatives`` rows of other labels are returned whose
    score is at least ``least`` and at most ``most`` of the positive's: (anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score). There may be none.

    Rows that do not take part: see ``usable``. Vectors of different lengths are compared by
    the components both have, so an empty one scores 0. Rows that share an id are rows of
    their own, which are not compared with each other; repeated ones give repeated results. No
    rows give no rows. A score beyond 64 bits fails, and does not wrap. Other columns are not read.

    Anchors are a share of all rows, so they are dealt with in blocks of ``BLOCK_BYTES`` (or of
    ``block`` anchors), one after the other; the driver holds one block and its positives.
    """
    spark = rows.sparkSession
    used = usable(rows, scale)
    anchors = materialize(used.filter(is_anchor))
    out = scratch_path(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for part in _blocks(anchors, block):
        _mine(used, part, positives, negatives, least, most).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _blocks(anchors: DataFrame, block: int | None) -> Iterator[list[tuple]]:
    rows = anchors.toLocalIterator()
    while head := list(islice(rows, 1)):
        size = block or max(1, BLOCK_BYTES // (8 * max(1, len(head[0][2]))))
        yield head + list(islice(rows, size - 1))


def _mine(used: DataFrame, part: Sequence[tuple], positives: int, negatives: int,
          least: Fraction, most: Fraction) -> DataFrame:
    spark = used.sparkSession
    ids, labels = np.array([r[0] for r in part]), np.array([r[1] for r in part])
    vectors = whole_numbers([r[2] for r in part])
    # The first time a slot is an anchor, whatever the score; the second time it is a positive
    # of an anchor, with the range of scores it allows.
    every = np.full(len(part), np.iinfo(np.int64).min), np.full(len(part), np.iinfo(np.int64).max)
    sent = spark.sparkContext.broadcast((ids, labels, vectors, np.arange(len(part)), *every))
    near = sorted(_first(used.mapInArrow(_finder(sent, positives, True), _FOUND), positives).collect(),
                  key=lambda r: (r.slot, r.rank))
    low = np.array([-(-r.score * least.numerator // least.denominator) for r in near], np.int64)
    high = np.array([r.score * most.numerator // most.denominator for r in near], np.int64)
    ranges = spark.sparkContext.broadcast((ids, labels, vectors, np.array([r.slot for r in near], np.int64), low, high))
    far = _first(used.mapInArrow(_finder(ranges, negatives, False), _FOUND), negatives)
    told = spark.createDataFrame(pa.table({
        "slot": pa.array(range(len(near)), pa.int64()),
        "anchor_id": pa.array([int(ids[r.slot]) for r in near], pa.int64()),
        "positive_id": pa.array([r.vec_id for r in near], pa.int64()),
        "positive_score": pa.array([r.score for r in near], pa.int64())}))
    return far.join(F.broadcast(told), "slot").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


_FOUND = "slot long, score long, vec_id long"


def _first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each slot; first among those of one task, so that no task meets them all."""
    order = [F.desc("score"), F.asc("vec_id")]
    partly = Window.partitionBy("slot", "bucket").orderBy(*order)
    wholly = Window.partitionBy("slot").orderBy(*order)
    merged = (found.withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(64)))
              .withColumn("rank", F.row_number().over(partly)).filter(F.col("rank") <= k).drop("bucket", "rank"))
    return merged.withColumn("rank", F.row_number().over(wholly)).filter(F.col("rank") <= k)


# ---- tasks -----------------------------------------------------------------

def whole_numbers(vectors: Sequence[Sequence[float]]) -> np.ndarray:
    """A row per vector of floored components, zeros behind the shorter ones: int64, or Python's integers
    where those are too small."""
    width = max(map(len, vectors), default=0)
    matrix = np.zeros((len(vectors), width))
    for row, vector in zip(matrix, vectors):
        row[:len(vector)] = vector
    return _integers(np.floor(matrix))


def _integers(matrix: np.ndarray) -> np.ndarray:
    if matrix.size and np.abs(matrix).max() >= 2.0 ** 52:
        return np.frompyfunc(int, 1, 1)(matrix)
    return matrix.astype(np.int64)


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices of whole numbers, by packed products."""
    common = min(anchors.shape[1], candidates.shape[1])
    anchors, candidates = anchors[:, :common], candidates[:, :common]
    if not anchors.size or not candidates.size:
        return np.zeros((len(anchors), len(candidates)), np.int64)
    bias_a, bias_c = -int(anchors.min()), -int(candidates.min())
    most = common * (int(anchors.max()) + bias_a) * (int(candidates.max()) + bias_c)
    width = max(1, most.bit_length())
    fields = max(1, WORD_BITS // width)
    # What is taken off again must fit as well, or Python's integers are the wide ones.
    reach = [max(abs(int(m.min())), abs(int(m.max()))) for m in (anchors, candidates)]
    kind = np.uint64 if (4 * common * reach[0] * reach[1]).bit_length() <= SAFE_BITS else object
    packed = pack((candidates + bias_c).astype(kind), width, fields)
    products = (anchors + bias_a).astype(kind) @ packed
    found = unpack(products, width, fields)[:, :len(candidates)]
    # sum (a + p)(c + q) = sum ac + q sum a + p sum c + n p q
    if kind is object:
        anchors, candidates = anchors.astype(object), candidates.astype(object)
    else:
        found = found.astype(np.int64)
    return (found - bias_c * anchors.sum(axis=1)[:, None] - bias_a * candidates.sum(axis=1)[None, :]
            - common * bias_a * bias_c)


def pack(values: np.ndarray, width: int, fields: int) -> np.ndarray:
    """A column per word: component by component, ``fields`` rows of ``values`` side by side."""
    rows = -(-len(values) // fields) * fields
    padded = np.zeros((rows, values.shape[1]), values.dtype)
    padded[:len(values)] = values
    words = padded[0::fields].copy()
    for f in range(1, fields):
        words |= padded[f::fields] << values.dtype.type(width * f) if values.dtype != object else \
            padded[f::fields] << (width * f)
    return words.T


def unpack(products: np.ndarray, width: int, fields: int) -> np.ndarray:
    out = np.empty((products.shape[0], products.shape[1] * fields), products.dtype)
    for f in range(fields):
        if products.dtype == object:
            out[:, f::fields] = (products >> (width * f)) & ((1 << width) - 1)
        else:
            out[:, f::fields] = (products >> np.uint64(width * f)) & np.uint64((1 << width) - 1)
    return out


def _finder(sent: Broadcast, k: int, same: bool) -> ArrowFunction:
    """Candidates for each slot: of each tile of rows the ``k`` best, but none that is worse
    than the ``k``-th best of an earlier one."""
    def run(batches):
        ids, labels, vectors, of, low, high = sent.value
        low = low.copy()
        for rows in _tiles(batches):
            own, kinds, candidates = rows
            for first in range(0, len(ids), ANCHOR_TILE):
                tile = slice(first, first + ANCHOR_TILE)
                fits = labels[tile, None] == kinds
                fits = fits & (ids[tile, None] != own) if same else ~fits
                a, b = np.searchsorted(of, [first, first + ANCHOR_TILE])
                value = scores(vectors[tile], candidates)[of[a:b] - first]
                wanted = fits[of[a:b] - first] & (value >= low[a:b, None]) & (value <= high[a:b, None])
                slot, place = np.nonzero(best(value, wanted.astype(bool), low[a:b], k))
                if len(slot):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot + a, pa.int64()), pa.array(value[slot, place].tolist(), pa.int64()),
                         pa.array(own[place], pa.int64())], ["slot", "score", "vec_id"])
    return run


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and whole numbers of at most ``ROW_TILE`` rows at a time, by ascending id."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROW_TILE):
            rows = batch.slice(start, ROW_TILE)
            rows = rows.take(pa.array(np.argsort(rows.column(0).to_numpy(), kind="stable")))
            yield rows.column(0).to_numpy(), rows.column(1).to_numpy(), _vectors(rows.column(2))


def _vectors(column: pa.ListArray) -> np.ndarray:
    widths = np.unique(column.value_lengths().to_numpy())
    if len(widths) > 1:
        return whole_numbers(column.to_pylist())
    return _integers(np.floor(column.flatten().to_numpy().reshape(len(column), -1 if len(column) and widths[0] else 0)))


def best(value: np.ndarray, wanted: np.ndarray, low: np.ndarray, k: int) -> np.ndarray:
    """Of the entries wanted in each row the ``k`` greatest, of equal ones the left. ``low`` is raised in
    place to the ``k``-th: what is below can't be among the best of all tiles."""
    many = np.flatnonzero(wanted.sum(axis=1) > k)
    if many.size:
        some, held = wanted[many], value[many]
        ranked = np.sort(np.where(some, held, held.min() - 1), axis=1) if held.dtype == object else \
            np.partition(np.where(some, held, np.iinfo(np.int64).min), held.shape[1] - k, axis=1)
        kth = ranked[:, -k]
        above, level = some & (held > kth[:, None]), some & (held == kth[:, None])
        open_places = k - above.sum(axis=1, keepdims=True)
        wanted[many] = above | (level & (np.cumsum(level, axis=1) <= open_places))
        low[many] = np.maximum(low[many], kth)
    return wanted
