"""Stored tables: counts from footers, sizes of files, skipped row groups; deliveries and vocabularies."""

import pytest
from pyspark.sql import functions as F

from tagshelf import sources
from tagshelf.operators import embed, profiles
from tagshelf.plans import catalogue
from tagshelf.sources import footers


@pytest.fixture
def table(spark, tmp_path):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("a`b"), F.lit(None).cast("string").alias("empty"),
        F.when(F.col("id") % 2 == 0, F.array("id")).alias("list"))
    path = str(tmp_path / "t")
    df.repartition(3).write.parquet(path)
    return df, path


def test_counts_from_footers(spark, table):
    df, path = table
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    rows, filled = sources.stored_counts(spark, path)
    want = {r["column"]: r.non_null for r in profiles.null_profile(df.withColumnRenamed("a`b", "b")).collect()}
    assert rows == 5000 and filled == {"id": 5000, "a`b": want["b"], "empty": 0, "list": 2500}
    assert {(r["column"], r.non_null) for r in sources.stored_null_profile(spark, path).collect()} == set(filled.items())
    assert sources.read_filled_columns(spark, path).columns == ["id", "a`b", "list"]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_the_plan_of_counts_reads_no_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(id as string) as s").write.parquet(path)
    assert "PushedAggregation: [COUNT(*), COUNT(id), COUNT(s)]" in footers.counting_plan(spark, path)
    spark.range(0).selectExpr("id", "cast(id as string) as s").write.parquet(str(tmp_path / "none"))
    assert sources.stored_counts(spark, str(tmp_path / "none")) == (0, {"id": 0, "s": 0})


def test_columns_with_very_long_values_have_no_counts_in_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).selectExpr("id", "if(id % 2 = 0, repeat('x', 20000), null) as s", "cast(id as string) as t").write.parquet(path)
    assert sources.stored_counts(spark, path) == (20, {"id": 20, "s": 10, "t": 20})
    assert sources.stored_counts(spark, path, ["t", "id"])[1] == {"t": 20, "id": 20}


def scanned(df):
    """Rows that the scan of ``df`` put out."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_files_of_one_size_in_order(spark, tmp_path):
    df = spark.range(40_000, numPartitions=13).selectExpr(
        "cast(id % 7 as double) / 6 as completeness", "sha2(cast(id as string), 256) as text", "id")
    path = str(tmp_path / "t")
    sources.write_parquet(df, path, order=["completeness"], file_bytes=1 << 20, group_bytes=64 << 10)
    back = spark.read.parquet(path)
    files = len(back.inputFiles())
    assert 4 <= files <= 8 and back.count() == 40_000
    found = back.filter("completeness > 0.9")
    assert found.count() == df.filter("completeness > 0.9").count()
    assert scanned(found) < 14_000
    # One value in all rows still makes files of one size.
    sources.write_parquet(df.withColumn("completeness", F.lit(1.0)), path, order=["completeness"], file_bytes=1 << 20)
    sizes = [r.n for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == files and max(sizes) < 2 * 40_000 / files
    sources.write_parquet(df, path, file_bytes=1 << 30)
    assert len(spark.read.parquet(path).inputFiles()) == 1
    sources.write_parquet(df, path, order=["id"])
    assert spark.read.parquet(path).count() == 40_000
    with pytest.raises(ValueError):
        sources.write_parquet(df, path, by="id", file_bytes=1)


def test_a_vocabulary_that_does_not_fit(spark):
    df = spark.createDataFrame([(["a"] * 5 + ["b"] * 3 + ["c", "d"],), (["b", "e"],), (None,)], "tokens array<string>")
    assert embed.check_vocabulary(df) == 5 and embed.check_vocabulary(df, min_count=2) == 2
    with pytest.raises(embed.VocabularyError, match="min_count=4 fits") as error:
        embed.fit_word_model(df, max_words=4)
    assert (error.value.words, error.value.min_count) == (5, 4)
    with pytest.raises(embed.VocabularyError) as error:
        embed.check_vocabulary(df.select(F.lit(["a", "b"]).alias("tokens")), max_words=1)
    assert error.value.min_count == 4
    assert embed.check_vocabulary(df.limit(0)) == 0
    model = embed.fit_word_model(df, max_words=2, min_count=error.value.min_count, vector_size=3, num_partitions=1)
    assert {r.word for r in embed.word_vectors(model).collect()} == {"a", "b"}


def test_a_delivery_embedded_in_part(spark, vectors, tmp_path):
    old = [("u1", ["potato"]), ("u2", ["chip", "stew"]), ("u3", ["gone"]), (None, ["stew"]), ("u5", None), ("u2", ["chip", "stew"])]
    new = [("u1", ["potato"]), ("u2", ["chip"]), ("u4", ["stew"]), (None, ["stew"]), ("u5", None), ("u6", [])]
    frame = lambda rows: spark.createDataFrame(rows, "url string, tokens array<string>")
    paths = [str(tmp_path / n) for n in ("vectors", "products", "new")]
    sources.write_parquet(vectors, paths[0])
    # What is stored for u1 is marked, to see that it is taken over.
    stored = embed.embed_rows(frame(old), vectors).withColumn(
        "embedding", F.when(F.col("url") == "u1", F.array(F.lit(7.0), F.lit(7.0))).otherwise(F.col("embedding")))
    sources.write_parquet(stored, paths[1])
    catalogue.update(frame(new), paths[1], paths[0], paths[2])
    got = {r.url: (r.tokens, r.embedding, r.norm) for r in spark.read.parquet(paths[2]).collect()}
    want = {r.url: (r.tokens, r.embedding, r.norm) for r in embed.embed_rows(frame(new), vectors).collect()}
    assert got.pop("u1")[1] == [7.0, 7.0] and want.pop("u1")
    assert got == want
    with pytest.raises(ValueError):
        catalogue.update(frame(new), paths[1], paths[0], paths[1] + "/")
