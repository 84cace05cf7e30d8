import gzip
import os

import pytest

from tagshelf import sources
from tagshelf.__main__ import main
from tagshelf.operators.columns import DISPLAY_COLUMNS
from tagshelf.plans import catalogue


def test_reading_text(spark, tmp_path):
    path = tmp_path / "t.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write('a\tb\tc\n1\t""\tx\n2\n3\t\té\n')
    df = sources.read_delimited(spark, str(path), min_partitions=3)
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert df.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in df.collect()) == [("1", None, "x"), ("2", None, None), ("3", None, "é")]
    named = sources.read_delimited(spark, str(path), columns=["a", "b", "c"])
    assert sorted(named.collect()) == sorted(df.collect())


def test_unbalanced_quotes(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text('a\tb\n"x\ty\n')
    assert sources.read_delimited(spark, str(path)).first().b is None
    assert tuple(sources.read_delimited(spark, str(path), quote="").first()) == ('"x', "y")


def test_text_round_trip(spark, rows, tmp_path):
    data = [('q"uo\\te', "line\nbreak, comma"), (None, ""), (" blank ", "é"), ("\\", '"'), ('""', "a\tb")]
    df = rows("a b", data)
    path = str(tmp_path / "out")
    for _ in range(2):  # the second run replaces the first
        sources.write_delimited(df, path)
    back = sources.read_delimited(spark, path, ",", multi_line=True)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [(a or None, b or None) for a, b in data], key=repr)
    one_line = df.filter("b not like 'line%' or b is null")
    sources.write_delimited(one_line, path)
    assert sources.read_delimited(spark, path, ",").count() == 4
    sources.write_delimited(one_line.filter("a = ' blank '"), path, keep_spaces=False)
    assert sources.read_delimited(spark, path, ",").first().a == "blank"


def test_scratch_folder_is_only_guessed_for_a_local_session():
    from tagshelf.sources.scratch import _base_folder
    assert _base_folder("hdfs://x/y", "yarn") == "hdfs://x/y"
    assert _base_folder(None, "local") == _base_folder("", "local[8]")
    for master in ("local-cluster[2,1,1024]", "spark://somewhere:7077", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _base_folder(None, master)


def test_dropping_one_intermediate_table(spark, rows):
    one, two = (sources.materialize(rows("a", [("1",)])) for _ in range(2))
    path = one.inputFiles()[0].removeprefix("file://")
    sources.drop_scratch(one)
    assert not os.path.exists(path) and two.count() == 1
    with pytest.raises(ValueError):
        sources.drop_scratch(spark.read.parquet("/root/testdata/sf0.001/region.parquet"))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

    class Conf:
        @staticmethod
        def get(name, default):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.scratch_path(Session)


def test_from_raw_text_to_a_search(spark, rows, tmp_path, capsys):
    names = ("code countries_tags product_name generic_name categories_en ingredients_tags"
             " ingredients_analysis_tags main_category categories_tags url brands nutriscore_grade nova_group"
             " image_url creator fat_100g cities")
    food = ["potato-chips", "apple-juice", "potato-soup", "orange-juice"]
    data = [(str(i), "en:france", f"name {i}", "g", "c", "i", "a", f"en:{food[i % 4]}",
             "en:snacks" if i % 5 else "fr:en-cas", f"u{i:02}", "b", "a", "1", "i", "x", "3", None) for i in range(40)]
    raw, out = str(tmp_path / "raw"), {n: str(tmp_path / n) for n in ("model", "products", "vectors")}
    sources.write_delimited(rows(names, data), raw, "\t", compression="gzip")
    files = [f"--products={out['products']}", f"--vectors={out['vectors']}"]
    main(["build", raw, "--train", "--min-partitions=3", "--drop-empty", f"--model={out['model']}", *files])

    products = sources.read_parquet(spark, out["products"])
    assert products.count() == 32
    assert {"creator", "fat_100g", "cities", "countries_tags"}.isdisjoint(products.columns)
    assert {"completeness", "tokens", "embedding", "norm"} <= set(products.columns)
    assert len(products.first().embedding) == 100

    best = catalogue.search(spark, "juice", out["products"], out["vectors"], 5)
    assert best.count() == 5 and best.first().similarity <= 1 + 1e-9
    main(["search", "Potato", "--limit", "3", *files])
    assert "similarity" in capsys.readouterr().out
    with pytest.raises(SystemExit, match="no word of"):
        main(["search", "unheard", *files])
    asked, results = str(tmp_path / "asked"), str(tmp_path / "results")
    sources.write_delimited(rows("query_id text", [("1", "potato-soup"), ("2", "juice\n")]), asked, "\t")
    main(["search-batch", asked, results, "--limit", "2", "--multi-line", *files])
    assert sources.read_delimited(spark, results).groupBy("query_id").count().filter("count = 2").count() == 2

    queries = spark.createDataFrame([(1, "POTATO soup"), (2, "unheard-of")], "query_id int, text string")
    stored = [str(tmp_path / n) for n in ("by_cluster", "vectors", "centres")]
    places = [f"--{n}={p}" for n, p in zip(("products", "vectors", "centres"), stored)]
    main(["build", raw, "--min-partitions=3", "--clusters=3", f"--model={out['model']}", *places])
    assert sources.read_parquet(spark, stored[0]).count() == 32
    same = catalogue.search(spark, "juice", *stored[:2], 5, centres_path=stored[2])
    assert [(r.url, r.similarity) for r in same.collect()] == [(r.url, r.similarity) for r in best.collect()]
    both = [sorted(map(tuple, catalogue.search_batch(queries, *files, 4, **more).select("query_id", "rank", "url").collect()))
            for files, more in ((stored[:2], {"centres_path": stored[2]}), ((out["products"], out["vectors"]), {}))]
    assert both[0] == both[1] and len(both[0]) == 4
    main(["search", "Potato", "--limit", "3", *places])
    found = catalogue.search_batch(queries, out["products"], out["vectors"], 4)
    assert {r.query_id for r in found.collect()} == {1} and found.count() == 4
    assert set(DISPLAY_COLUMNS) <= set(found.columns)
    alone = catalogue.search(spark, "potato soup", out["products"], out["vectors"], 4).collect()
    assert [r.url for r in found.orderBy("rank").collect()] == [r.url for r in alone]

    recipes = spark.createDataFrame([("r1", "Potato, salt,JUICE"), ("r2", "juice")], "id string, text string")
    by_part = catalogue.search_ingredients(recipes, out["products"], out["vectors"], 2, key="id")
    assert [(r.id, r.pos, r.ingredient, r["rank"]) for r in by_part.orderBy("id", "pos", "rank").collect()] == [
        ("r1", 0, "potato", 1), ("r1", 0, "potato", 2), ("r1", 2, "juice", 1), ("r1", 2, "juice", 2),
        ("r2", 0, "juice", 1), ("r2", 0, "juice", 2)]
    assert {"product_name", "similarity"} <= set(by_part.columns)

    recipe = spark.createDataFrame([("r3", "Boil the potato\nsoup; add juice, JUICE and salt.")], "id string, text string")
    known = rows("word", [("potato soup",), ("soup",), ("juice",), ("Salt",)])
    mentioned = catalogue.search_recipes(recipe, known, out["products"], out["vectors"], 1, key="id")
    assert sorted((r.id, r.ingredient, r["count"], r["rank"]) for r in mentioned.collect()) == [
        ("r3", "juice", 2, 1), ("r3", "potato soup", 1, 1)]


def test_clearing_intermediate_tables(spark, rows):
    df = sources.materialize(rows("a", [("1",)]))
    assert df.count() == 1
    file = df.inputFiles()[0].removeprefix("file://")
    sources.clear_scratch(spark)
    assert not os.path.exists(file)
