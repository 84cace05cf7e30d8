import math
import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import functions as F

from tagshelf.functions.vectors import cosine
from tagshelf.operators import embed, search
from tagshelf.operators.columns import DISPLAY_COLUMNS

PATHS = [{}, {"broadcast_bytes": -1, "hot_rows": 2}]


@pytest.fixture(scope="module")
def bagged(spark):
    data = [("a", ["chip", "potato"]), ("b", ["chip", "potato"]), ("c", []), ("d", None), ("e", ["zzz"]),
            ("f", ["chip", "zzz"]), ("g", ["stew"])]
    return spark.createDataFrame(data, "url string, tokens array<string>")


@pytest.mark.parametrize("options", PATHS)
def test_embed_rows(shuffled_joins, bagged, vectors, options):
    got = {r.url: (r.embedding, r.norm) for r in embed.embed_rows(bagged, vectors, **options).collect()}
    half = (pytest.approx([0.5, 0.5]), pytest.approx(math.sqrt(0.5)))
    zero = ([0.0, 0.0], 0.0)
    assert got == {"a": half, "b": half, "c": zero, "d": zero, "e": zero, "f": ([0.0, 0.5], 0.5),
                   "g": ([3.0, 4.0], 5.0)}


def test_embed_rows_keeps_copies(spark, vectors):
    df = spark.createDataFrame([("x", ["chip"])] * 5, "url string, tokens array<string>")
    assert embed.embed_rows(df, vectors).count() == 5


@pytest.mark.parametrize("options", PATHS)
def test_query_vectors(shuffled_joins, spark, vectors, options):
    queries = spark.createDataFrame(
        [(1, "  Potato potato chip zzz "), (2, "zzz"), (3, " "), (4, None)], "query_id long, text string")
    lower = search.query_vectors(queries, vectors, lower=True, **options).collect()
    assert [(r.query_id, r.vector) for r in lower] == [(1, pytest.approx([2 / 3, 1 / 3]))]
    exact = search.query_vectors(queries, vectors, lower=False, **options).collect()
    assert [(r.query_id, r.vector) for r in exact] == [(1, pytest.approx([0.5, 0.5]))]
    covered = search.query_coverage(queries, vectors, lower=True, **options).orderBy("query_id").collect()
    assert [tuple(r) for r in covered] == [(1, 3, 1), (2, 0, 1), (3, 0, 0), (4, 0, 0)]


def test_text_vector(vectors):
    assert search.text_vector(" potato potato chip zzz", vectors) == pytest.approx([2 / 3, 1 / 3])
    assert search.text_vector("POTATO", vectors, lower=True) == [1.0, 0.0]
    for text in ("POTATO", "", "x' or '1'='1", "potato'"):
        with pytest.raises(search.UnknownWordsError):
            search.text_vector(text, vectors, lower=False)


def test_one_query_and_many_are_treated_alike(spark, vectors):
    asked = spark.createDataFrame([(1, "Potato-CHIP")], "query_id int, text string")
    with pytest.raises(search.UnknownWordsError):
        search.text_vector("Potato-CHIP", vectors)
    assert search.query_vectors(asked, vectors).count() == 0
    assert search.text_vector("Potato-CHIP", vectors, split_hyphens=True) == [0.5, 0.5]
    assert search.query_vectors(asked, vectors, split_hyphens=True).first().vector == [0.5, 0.5]
    assert search.query_coverage(asked, vectors, split_hyphens=True).first().known_words == 2


def test_what_is_no_number_is_left_out(spark):
    data = [("a", [1.0, 0.0]), ("b", [float("nan"), 1.0]), ("c", None), ("d", [1.0, 1.0])]
    df = embed.with_norm(spark.createDataFrame(data, "code string, embedding array<double>"))
    assert [r.code for r in search.top_similar(df, [1.0, 0.0], 4, key="code").collect()] == ["a", "d"]
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, vector array<double>")
    found = search.nearest(df, asked, 4, key="code")
    assert [r.code for r in found.orderBy("rank").collect()] == ["a", "d"]
    for name in DISPLAY_COLUMNS:
        df = df.withColumn(name, F.lit(name))
    assert {r.code for r in search.with_display(found, df, key="code").collect()} == {"a", "d"}


def test_several_blocks_write_k_rows_a_query(spark, monkeypatch):
    written = []
    monkeypatch.setattr(search, "scratch_path", lambda s: written.append(real(s)) or written[-1])
    df = spark.range(600).selectExpr("cast(id as string) as url", "array(cos(id), sin(id)) as embedding").repartition(8)
    asked = spark.range(20).selectExpr("id as query_id", "array(cos(id / 7), sin(id / 7)) as vector")
    found = search.nearest(df, asked, 3, block=7)
    assert spark.read.parquet(written[-1]).count() == 60
    assert sorted(found.collect()) == sorted(search.nearest(df, asked, 3).collect())


real = search.scratch_path
numbers = st.lists(st.floats(-100, 100), min_size=3, max_size=3)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(numbers, numbers), min_size=1, max_size=20))
def test_cosine(spark, pairs):
    df = spark.createDataFrame(pairs, "a array<double>, b array<double>")
    scaled = F.transform("a", lambda x: x * 4)
    for a, b, x, y, z in df.select("a", "b", cosine("a", "b"), cosine("b", "a"), cosine(scaled, "b")).collect():
        lengths = np.linalg.norm(a) * np.linalg.norm(b)
        if lengths == 0:
            assert x == y == z == 0.0
        elif lengths > 1e-100:
            assert x == pytest.approx(np.dot(a, b) / lengths, abs=1e-9)
            assert -1 - 1e-9 <= x <= 1 + 1e-9 and x == pytest.approx(y) and x == pytest.approx(z)


def test_top_similar_is_the_head_of_the_full_order(bagged, vectors):
    df = embed.embed_rows(bagged, vectors)
    everything = search.top_similar(df, [1.0, 1.0], 100)
    assert [r.url for r in everything.collect()] == ["a", "b", "g", "f", "c", "d", "e"]
    assert search.top_similar(df, [1.0, 1.0], 3).collect() == everything.collect()[:3]
    assert {r.similarity for r in search.top_similar(df, [0.0, 0.0], 9).collect()} == {0.0}
    assert search.cosine_similarity(df.drop("norm"), [0.0, 2.0]).filter("url = 'f'").first().similarity == 1.0


def test_recommend(bagged, vectors):
    df = embed.embed_rows(bagged, vectors)
    for name in DISPLAY_COLUMNS:
        if name != "url":
            df = df.withColumn(name, F.lit(name))
    assert [r.url for r in search.recommend(df, "chip nothing", vectors, 2).collect()] == ["f", "g"]
    shown = search.recommend_display(df, " CHIP ", vectors, 2)
    assert shown.columns == [*DISPLAY_COLUMNS, "similarity", "similarity_text"]
    assert [r.similarity_text for r in shown.collect()] == ["100.00", "80.00"]
    queries = df.sparkSession.createDataFrame([("q", "chip")], "query_id string, text string")
    found = search.recommend_batch(df, queries, vectors, 2)
    assert found.columns == ["query_id", "rank", "url", "similarity"]
    assert [tuple(r) for r in found.orderBy("rank").collect()] == [("q", 1, "f", 1.0), ("q", 2, "g", 0.8)]
    displayed = search.with_display(found, df).orderBy("rank").collect()
    assert [(r.rank, r.url, r.brands) for r in displayed] == [(1, "f", "brands"), (2, "g", "brands")]


def brute_force(products, queries, k, digits):
    """Every query against every product, in Python."""
    out = []
    for q, b in queries:
        scored = []
        for p, a in products:
            lengths = np.linalg.norm(a) * np.linalg.norm(b)
            scored.append((-round(float(np.dot(a, b) / lengths) if lengths else 0.0, digits) + 0.0, p))
        out += [(q, i + 1, p, -s + 0.0) for i, (s, p) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 1000])
def test_nearest_against_brute_force(spark, block):
    chance = random.Random(7)

    def vector():
        return [float(chance.randint(-2, 2)) for _ in range(3)]  # few values: many equal similarities
    products = [(f"p{i:03}", vector()) for i in range(200)]
    # A third of all products are the same.
    products += [(f"s{i:03}", [1.0, 0.0, 1.0]) for i in range(100)]
    queries = [(i, vector()) for i in range(10)] + [(10, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(products, "url string, embedding array<double>").repartition(5)
    asked = spark.createDataFrame(queries, "query_id int, vector array<double>")
    for k in (1, 10, 1000):
        got = search.nearest(df, asked, k, block=block).collect()
        assert sorted(tuple(r) for r in got) == brute_force(products, queries, k, 6)


def test_nearest_with_small_batches_and_no_queries(spark):
    df = spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(50)], "id int, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = search.nearest(df, asked, 4, key="id").orderBy("rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.id for r in got] == [4, 9, 14, 19]
    assert search.nearest(df, asked.limit(0), 4, key="id").count() == 0


def test_native_embedding_agrees_with_the_model(spark, tmp_path):
    data = [(str(i), [f"w{i % 5}", f"w{i % 3 + 5}"]) for i in range(60)] + [("none", None), ("empty", [])]
    df = spark.createDataFrame(data, "url string, tokens array<string>")
    model = embed.fit_word_model(df, vector_size=8, num_partitions=1)
    model.write().overwrite().save(str(tmp_path / "model"))
    model = Word2VecModel.load(str(tmp_path / "model"))
    df = df.union(spark.createDataFrame([("new", ["w1", "unseen"])], df.schema))
    by_model = {r.url: r.embedding for r in embed.embed_with_model(df, model).collect()}
    native = {r.url: r.embedding for r in embed.embed_rows(df, embed.word_vectors(model)).collect()}
    assert by_model.keys() == native.keys() and len(native) == 63
    for url, vector in by_model.items():
        assert native[url] == pytest.approx(vector)
    assert by_model["none"] == by_model["empty"] == [0.0] * 8
    assert any(by_model["new"])


def test_training_is_repeatable(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b", "c"],)] * 10, "tokens array<string>")
    first, second = [sorted(embed.word_vectors(embed.fit_word_model(df, vector_size=4, num_partitions=1)).collect())
                     for _ in range(2)]
    assert first == second and [r.word for r in first] == ["a", "b", "c"]


def test_training_does_not_depend_on_the_cluster(monkeypatch, spark):
    asked = []

    class Trainer:
        def __init__(self, **settings):
            asked.append(settings["numPartitions"])

        def fit(self, df):
            return None

    monkeypatch.setattr(embed, "Word2Vec", Trainer)
    df = spark.createDataFrame([(["a"],)], "tokens array<string>")
    for cores in (2, 4):
        monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", cores, raising=False)
        embed.fit_word_model(df)
    assert asked == [embed.NUM_PARTITIONS] * 2


def test_training_at_the_default_finds_topics(spark):
    chance = random.Random(1)
    data = [([f"t{t}w{chance.randrange(10)}" for _ in range(6)],) for t in range(20) for _ in range(200)]
    chance.shuffle(data)
    df = spark.createDataFrame(data, "tokens array<string>").repartition(4)
    table = {r.word: np.array(r.vector) for r in
             embed.word_vectors(embed.fit_word_model(df, vector_size=20, max_iter=5)).collect()}
    words, units = list(table), np.array([v / np.linalg.norm(v) for v in table.values()])
    similar = units @ units.T - 2 * np.eye(len(words))
    nearest = [words[i] for i in similar.argmax(axis=1)]
    assert np.mean([w.split("w")[0] == n.split("w")[0] for w, n in zip(words, nearest)]) > 0.95


def test_tasks_need_no_installed_package(tmp_path):
    repo = Path(__file__).resolve().parent.parent
    script = f"""
import sys
sys.path.insert(0, {str(repo)!r})
from pyspark.sql import SparkSession
from tagshelf.operators import search
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
products = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "url string, embedding array<double>")
queries = spark.createDataFrame([(1, [0.0, 2.0])], "query_id int, vector array<double>")
print("best", search.nearest(products, queries, 1).first().url)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=200)
    assert "best b" in done.stdout, done.stderr[-2000:]
