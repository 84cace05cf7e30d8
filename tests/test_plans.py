"""What Spark plans for the operators: the things that decide how they scale."""

import re

import __spark_entry__ as entries
import pytest

from tagshelf.operators import embed, english, filters, lookup, reports, search
from tagshelf.plans import catalogue, standin

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "products")
    standin.tokenised(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def embedded(stored, vectors):
    return embed.embed_rows(stored, vectors)


def test_country_filter_reaches_the_scan(stored):
    text = plan(filters.filter_country(stored, "fr").select("url"))
    assert "StringContains(countries_tags,en:fr)" in text
    assert "ReadSchema: struct<url:string,countries_tags:string>" in text


def test_no_python_in_the_native_path(embedded, vectors):
    text = plan(search.recommend(embedded, "potato", vectors))
    assert "TakeOrderedAndProject" in text
    assert "Python" not in text and "ArrowEval" not in text


def test_batch_search_limits_groups_before_it_shuffles(spark, embedded, vectors):
    queries = spark.createDataFrame([(1, "potato"), (2, "chip")], "query_id int, text string")
    text = plan(search.recommend_batch(embedded, queries, vectors))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "MapInArrow" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_english_only_does_not_shuffle_the_wide_rows(stored):
    text = plan(english.english_only(stored))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "Exchange hashpartitioning" not in text


def test_beyond_the_broadcast_size_the_shuffle_is_salted(spark, stored, shuffled_joins):
    text = plan(english.english_only(stored, broadcast_bytes=-1, hot_rows=1))
    assert re.search(r"hashpartitioning\(code#\d+, _salt#\d+", text)
    assert re.search(r"(SortMerge|ShuffledHash)Join \[code#\d+, _salt#\d+\]", text)


def test_embedding_does_not_shuffle_the_wide_rows(embedded):
    text = plan(embedded)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_build_broadcasts_only_what_was_measured(spark, stored, tmp_path, monkeypatch, shuffled_joins):
    """With a limit of nothing, no table of vectors or means is broadcast."""
    texts = []
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(embed, "lookup_join", lambda *a, **b: lookup.lookup_join(*a, **{**b, "broadcast_bytes": -1}))
    monkeypatch.setattr(catalogue, "write_parquet", lambda df, path: texts.append(plan(df)) or df.write.parquet(path))
    catalogue.build(stored, *[str(tmp_path / n) for n in ("m", "p", "v")], train=True, vector_size=4)
    assert "BroadcastHashJoin" in texts[-1]  # of the few frequent keys
    assert "Python" not in texts[-1] and "UDF" not in texts[-1]
    # The means, which are written before they are joined, meet the rows in a shuffle.
    assert re.search(r"(SortMerge|ShuffledHash)Join \[tokens#\d+, _salt#\d+", texts[-1])


def test_reports_read_one_column_and_count_before_the_shuffle(stored):
    text = plan(reports.top_name_words(stored))
    assert "ReadSchema: struct<product_name:string>" in text
    assert text.count("HashAggregate") >= 2 and "TakeOrderedAndProject" in text
    # The filter on words stands below the aggregates.
    assert text.rindex("length(word") > text.rindex("HashAggregate")


def test_measured_size_is_not_less_than_the_data(spark):
    df = spark.createDataFrame([("é" * 100, [1.0] * 50, ["ab"] * 10, 1)] * 20,
                               "s string, v array<double>, t array<string>, n int")
    assert lookup.row_bytes(df) >= 20 * (200 + 400 + 20 + 4)
    assert lookup.row_bytes(df.limit(0)) == 0


def test_queries_read_whole_tables(spark):
    for name in ("english_only", "top_name_words", "filter_country"):
        text = plan(entries.queries()[name](spark, SF_DIR))
        assert "LocalLimit" not in text.replace("TakeOrderedAndProject", "")
