"""Searches that skip clusters find what searches that read all do."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagshelf import sources
from tagshelf.operators import clusters, embed, search


def catalogue(seed, n=600, width=8, groups=12):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(groups)]
    rows = [(f"u{i:04}", [c + draw.gauss(0, 0.15) for c in draw.choice(centres)]) for i in range(n)]
    odd = [[0.0] * width, [0.0] * width, None, [math.nan] * width, [math.inf] + [1.0] * (width - 1), [1e-200] * width, [1e200] * width]
    return rows + [(f"v{i}", v) for i, v in enumerate(odd)] + [(f"w{i}", rows[0][1]) for i in range(30)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    frame = embed.with_norm(spark.createDataFrame(catalogue(1), "url string, embedding array<double>"))
    dealt, centres = clusters.cluster_products(sources.materialize(frame.repartition(5)), 12)
    path = str(tmp_path_factory.mktemp("clustered"))
    sources.write_parquet(dealt, path + "/products", by="cluster")
    sources.write_parquet(centres, path + "/centres")
    return frame, spark.read.parquet(path + "/products"), spark.read.parquet(path + "/centres")


def test_every_row_is_kept_and_within_reach_of_its_centre(stored):
    frame, products, centres = stored
    assert products.count() == frame.count()
    of = {r.url: r.cluster for r in products.select("url", "cluster").collect()}
    assert of["v0"] == of["v1"] == clusters.ZERO_CLUSTER and of["v2"] is of["v3"] is of["v4"] is None
    table = {r.cluster: r for r in centres.collect()}
    assert sum(r.rows for r in table.values()) == sum(c is not None for c in of.values())
    for r in products.filter("cluster >= 0").collect():
        unit = np.array(r.embedding) / np.linalg.norm(r.embedding)
        assert unit @ np.array(table[r.cluster].centre) >= table[r.cluster].least_cosine - 1e-12


QUERIES = [[1.0] + [0.0] * 7, [0.0] * 8, [-1.0, 2.0] * 4, [1e-3] * 8]


@pytest.mark.parametrize("k", [1, 10, 200, 10_000])
@pytest.mark.parametrize("digits", [6, None])
def test_one_query(stored, k, digits):
    frame, products, centres = stored
    # A zero query is as similar to vectors that are no numbers as to others; these are left out here.
    frame = frame.filter("url not in ('v3', 'v4')")
    for query in [*QUERIES, frame.first().embedding]:
        want = search.top_similar(frame, query, k, digits=digits).select("url", "similarity").collect()
        got = clusters.top_similar_clustered(products, centres, query, k, digits=digits).select("url", "similarity").collect()
        assert got == want or (digits is None and [r.url for r in got] == [r.url for r in want])


def queries(spark, frame):
    vectors = QUERIES + [r.embedding for r in frame.orderBy("url").limit(40).collect()]
    return spark.createDataFrame(list(enumerate(vectors)), "query_id int, vector array<double>")


@pytest.mark.parametrize("block", [None, 7])
def test_a_batch_of_queries(spark, stored, block):
    frame, products, centres = stored
    asked = queries(spark, frame)
    want = sorted(map(tuple, search.nearest(frame, asked, 5).collect()))
    assert sorted(map(tuple, clusters.nearest_clustered(products, centres, asked, 5, block=block).collect())) == want
    assert clusters.nearest_clustered(products, centres, asked.limit(0), 5).count() == 0


def test_what_cannot_be_near_is_neither_read_nor_multiplied(spark, stored):
    frame, products, centres = stored
    query = frame.orderBy("url").first().embedding
    found = clusters.top_similar_clustered(products, centres, query, 10)
    read = found.inputFiles()
    folders = {f.split("cluster=")[1].split("/")[0] for f in products.inputFiles()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cluster#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    asked = queries(spark, frame).filter("query_id >= 4")
    best = search.nearest(frame, asked, 5).groupBy("query_id").agg(F.min("similarity").alias("least")).orderBy("query_id")
    vectors = np.array([r.vector for r in asked.orderBy("query_id").collect()])
    wanted = clusters.planned(centres, vectors, np.array([r.least for r in best.collect()]))
    everything = np.ones_like(wanted)
    assert clusters.comparisons(centres, wanted) < clusters.comparisons(centres, everything) / 4
    assert len(folders) > 10 and read


def test_few_rows_and_none(spark):
    one = spark.createDataFrame([("a", [1.0, 2.0])], "url string, embedding array<double>")
    for frame in (one, one.limit(0), one.select("url", F.lit(None).cast("array<double>").alias("embedding"))):
        dealt, centres = clusters.cluster_products(frame)
        dealt, centres = sources.materialize(dealt), sources.materialize(centres)
        want = search.top_similar(embed.with_norm(frame), [1.0, 0.0], 3).select("url", "similarity").collect()
        assert clusters.top_similar_clustered(dealt, centres, [1.0, 0.0], 3).select("url", "similarity").collect() == want
    with pytest.raises(ValueError):
        clusters.cluster_products(one, 0)
