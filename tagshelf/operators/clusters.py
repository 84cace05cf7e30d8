"""Exact similarity search that reads only the clusters of products it has to.

A clustered product table has a ``cluster`` for each row and is stored by it. A table of
centres tells, per cluster, its centre on the unit sphere, the least cosine of a member to it and
the number of members. By the triangle inequality of angles no member is more similar to a query
than the cosine of (angle to the centre - greatest angle within). A search looks into the
clusters most promising first; what their k-th result is, others have to reach.

Results are those of ``search.top_similar`` and ``search.nearest``, which read every row; vectors
with components that are no finite numbers are never found, not even for a zero query.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions.blocks import cluster_scorer, unit_rows
from ..functions.vectors import dot, norm
from ..sources.scratch import materialize, scratch_path
from .embed import with_norm
from .search import BLOCK_BYTES, DIGITS, _best_per_query, _blocks, top_similar

# The driver and every task hold all centres: this many at most.
MAX_CLUSTERS = 4096
# Rows that centres are found from, about; all rows are dealt to them.
SAMPLE_ROWS = 200_000
# The cluster of vectors without a direction, which are similar to no query.
ZERO_CLUSTER = -1
# What the rounding of angles can add to a similarity.
ANGLE_ERROR = 1e-7
# Pairs of a query and a cluster judged in one pass; the driver holds a few numbers for each.
PAIRS = 1 << 23


def cluster_products(products: DataFrame, clusters: int | None = None, *, seed: int = 42,
                     max_iter: int = 10, sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``products`` with a ``cluster``, and the centres (cluster, centre, least_cosine, rows).

    Centres are found by k-means (Spark ML, cosine distance) on a sample of about ``sample_rows``
    rows; every row is then dealt to the nearest of them. They decide how much a search can skip
    and not what it finds. There are ``clusters`` of them, or as many as the square root of the
    number of rows, and ``MAX_CLUSTERS`` at most.

    Vectors without a length that can be divided by (zero vectors; some of beyond 1e150) are a
    cluster of their own. Rows that no search finds (without an embedding, or
    with a component that is no finite number) have none: NULL. ``products`` is read several
    times: store it first. Store the result by cluster (``write_parquet(..., by="cluster")``), and the
    centres beside it.
    """
    if clusters is not None and not 0 < clusters <= MAX_CLUSTERS:
        raise ValueError(f"between 1 and {MAX_CLUSTERS} clusters")
    length = norm("embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite, F.lit(False))
    proper = usable & (length > 0) & (length < float("inf"))
    n = products.filter(proper).count()
    wanted = clusters or min(MAX_CLUSTERS, max(1, int(n ** 0.5)))
    model = _fitted(products.filter(proper), n, wanted, seed, max_iter, sample_rows)
    if model is None:
        nearest, dealt = F.lit(0), products
    else:
        # The model takes no zero vector: rows that get no cluster from it show it another.
        other = F.array(*[F.lit(1.0)] * len(model.clusterCenters()[0]))
        shown = products.withColumn("_features", array_to_vector(F.when(proper, F.col("embedding")).otherwise(other)))
        nearest, dealt = F.col("_cluster"), model.transform(shown)
    cluster = F.when(~usable, F.lit(None)).when(~proper, F.lit(ZERO_CLUSTER)).otherwise(nearest)
    dealt = dealt.select(*products.columns, cluster.cast("int").alias("cluster"))
    if "norm" not in products.columns:
        dealt = with_norm(dealt)
    return dealt, _spread(dealt, model)


def top_similar_clustered(products: DataFrame, centres: DataFrame, query: Sequence[float], k: int = 10,
                          key: str = "url", digits: int | None = DIGITS) -> DataFrame:
    """``top_similar`` over a clustered table; a small search for the bound is made in the call."""
    known = _Centres(centres)
    bounds = known.bounds(np.array([query], dtype=float))[0]
    margin = _margin(digits)
    first = known.ids[known.home(bounds[None, :], k)[0]]
    found = top_similar(_of(products, first), query, k, key, digits).select("similarity").collect()
    least = min(r.similarity for r in found) if len(found) == k else -np.inf
    return top_similar(_of(products, known.ids[bounds >= least - margin]), query, k, key, digits)


def nearest_clustered(products: DataFrame, centres: DataFrame, queries: DataFrame, k: int = 10, *,
                      key: str = "url", query_key: str = "query_id", digits: int = DIGITS,
                      block: int | None = None) -> DataFrame:
    """``nearest`` over a clustered table: a query is compared with the clusters only that can serve it.

    Per block of queries there are two passes, in the call: the clusters each query is closest
    to, which give the ``k``-th similarity it can count on, then all those that may reach it.
    Results, at most ``k`` rows a query, are written to the shared folder.
    """
    known = _Centres(centres)
    queries = materialize(queries.select(query_key, "vector"))
    query_field, _ = queries.schema.fields
    key_field = products.schema[key]
    schema = StructType([query_field, key_field, StructField("similarity", DoubleType())])
    spark = products.sparkSession
    path = scratch_path(spark)
    done = _best_per_query(spark.createDataFrame([], schema), query_field.name, key, k)
    done.write.parquet(path)
    rows = queries.toLocalIterator()
    for head in iter(lambda: list(islice(rows, 1)), []):
        size = block or max(1, min(BLOCK_BYTES // (8 * max(1, len(head[0][1]))), PAIRS // max(1, len(known.ids))))
        part = next(_blocks(chain(head, islice(rows, size - 1)), size))
        _search_block(products, known, part, k, digits, schema).write.mode("append").parquet(path)
    return spark.read.schema(done.schema).parquet(path)


def comparisons(centres: DataFrame, wanted: np.ndarray) -> int:
    """Products multiplied with a query if ``wanted`` (query by cluster, as ``planned`` gives it) is searched."""
    return int((wanted * _Centres(centres).rows).sum())


def planned(centres: DataFrame, vectors: np.ndarray, least: np.ndarray, digits: int = DIGITS) -> np.ndarray:
    """Which clusters, in order of their id, can hold something as similar to each vector as ``least``."""
    return _Centres(centres).bounds(vectors) >= least[:, None] - _margin(digits)


def _search_block(products: DataFrame, known: _Centres, part: Sequence, k: int, digits: int,
                  schema: StructType) -> DataFrame:
    spark = products.sparkSession
    query_field, key_field, _ = schema.fields
    ids = pa.array([row[0] for row in part], to_arrow_type(query_field.dataType))
    units = unit_rows(np.array([row[1] for row in part], dtype=float))
    places = pa.array(range(len(part)), pa.int32())
    bounds = known.bounds(units)

    def compared(wanted: np.ndarray, least: np.ndarray, names: pa.Array, name: str, kind) -> DataFrame:
        lists = {int(c): np.flatnonzero(wanted[:, i]) for i, c in enumerate(known.ids)}
        sent = spark.sparkContext.broadcast((names, units, {c: q for c, q in lists.items() if len(q)}, least))
        read = _of(products, [c for c, q in lists.items() if len(q)]).select(key_field.name, "embedding", "cluster")
        out = StructType([StructField(name, kind), key_field, schema[2]])
        found = read.mapInArrow(cluster_scorer(sent, k, digits, out.names), out)
        return _best_per_query(found, name, key_field.name, k)

    home = np.zeros(bounds.shape, bool)
    for i, first in enumerate(known.home(bounds, k)):
        home[i, first] = True
    none = np.full(len(part), -np.inf)
    sure = compared(home, none, places, "_place", IntegerType()).groupBy("_place").agg(
        F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least"))
    least = none.copy()
    for row in sure.filter(F.col("n") == k).collect():      # a number per query of the block
        least[row["_place"]] = row["least"]
    return compared(bounds >= least[:, None] - _margin(digits), least, ids, query_field.name, query_field.dataType)


class _Centres:
    """All centres, on the driver: as many as ``MAX_CLUSTERS`` and that of zero vectors."""

    def __init__(self, table: DataFrame):
        found = table.orderBy("cluster").limit(MAX_CLUSTERS + 2).collect()
        if len(found) > MAX_CLUSTERS + 1:
            raise ValueError(f"more than {MAX_CLUSTERS} clusters")
        self.ids = np.array([r.cluster for r in found], dtype=int)
        self.rows = np.array([r.rows for r in found], dtype=int)
        self.zero = self.ids == ZERO_CLUSTER
        width = max((len(r.centre or ()) for r in found), default=0)
        self.units = np.array([r.centre or [0.0] * width for r in found], dtype=float).reshape(len(found), width)
        self.reach = np.arccos(np.clip([r.least_cosine for r in found], -1, 1))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest similarity that a member of each cluster can have to each query."""
        if not len(self.ids):
            return np.zeros((len(queries), 0))
        units = unit_rows(queries)
        empty = ~units.any(axis=1)
        cosines = np.clip(units @ self.units.T, -1, 1) if self.units.shape[1] else np.zeros((len(units), len(self.ids)))
        bounds = np.cos(np.maximum(0.0, np.arccos(cosines) - self.reach))
        bounds[:, self.zero] = 0.0
        bounds[empty] = 0.0
        # A query with a component that is no number may be anywhere; it finds nothing anyway.
        return np.where(np.isnan(bounds), 1.0, bounds)

    def home(self, bounds: np.ndarray, k: int) -> list[np.ndarray]:
        """Per query the places of the most promising clusters that hold ``k`` rows together."""
        order = np.argsort(-bounds, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1)
        return [o[:int(np.searchsorted(h, k)) + 1] for o, h in zip(order, held)]


def _margin(digits: int | None) -> float:
    return ANGLE_ERROR if digits is None else 10.0 ** -digits + ANGLE_ERROR


def _of(products: DataFrame, clusters: Sequence[int]) -> DataFrame:
    """The rows of some clusters. Stored by cluster, no other file is opened."""
    return products.filter(F.col("cluster").isin([int(c) for c in clusters]))


def _fitted(proper: DataFrame, n: int, wanted: int, seed: int, max_iter: int, sample_rows: int) -> KMeansModel | None:
    """The model that deals rows to clusters; None where one cluster holds all."""
    if min(n, wanted) < 2:
        return None
    sample = proper if n <= sample_rows else proper.sample(fraction=sample_rows / n, seed=seed)
    features = materialize(sample.select(array_to_vector("embedding").alias("_features")))
    return KMeans(k=wanted, seed=seed, maxIter=max_iter, distanceMeasure="cosine", featuresCol="_features",
                  predictionCol="_cluster").fit(features)


def _spread(dealt: DataFrame, model: KMeansModel | None) -> DataFrame:
    """The table of centres, from one aggregate over the members."""
    spark = dealt.sparkSession
    members = dealt.filter("cluster is not null")
    if model is None:
        # Any vector will do for the one centre; without a model there is none to be had.
        first = members.filter(F.col("cluster") != ZERO_CLUSTER).select("embedding").first()
        found = [] if first is None else [first["embedding"]]
    else:
        found = [c.tolist() for c in model.clusterCenters()]
    units = unit_rows(np.array(found, dtype=float)).tolist() if found else []
    known = spark.createDataFrame(list(enumerate(units)), "cluster int, centre array<double>")
    cosine = dot("embedding", "centre") / norm("embedding")
    return (members.join(F.broadcast(known), "cluster", "left").groupBy("cluster")
            .agg(F.coalesce(F.min(F.when(F.col("cluster") != ZERO_CLUSTER, cosine)), F.lit(1.0)).alias("least_cosine"),
                 F.count(F.lit(1)).alias("rows"))
            .join(F.broadcast(known), "cluster", "left").select("cluster", "centre", "least_cosine", "rows"))
