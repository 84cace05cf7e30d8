import pytest
from pyspark.sql import functions as F

from tagshelf.operators import columns, filters, profiles


def test_fixed_drops_ignore_absent_names(rows):
    df = rows("code cities creator completeness", [("1", None, "x", "0.5")])
    assert columns.drop_null_columns_fixed(df).columns == ["code", "creator", "completeness"]
    assert columns.drop_unused_columns(df).columns == ["code", "cities"]


def test_drops_by_name(rows):
    names = "code origins_tags manufacturing_places cities countries_en owner packaging_text" \
            " emb_codes states fat_100g created_t last_modified_datetime t_name"
    df = rows(names, [tuple("x" for _ in names.split())])
    assert columns.drop_columns_matching(df).columns == ["code", "created_t", "last_modified_datetime", "t_name"]
    kept = columns.drop_columns_suffix(df).columns
    assert "created_t" not in kept and "last_modified_datetime" not in kept and "t_name" in kept
    assert columns.split_columns(df)[0] == ["fat_100g"]


@pytest.mark.parametrize("probe_rows", [0, 1, 100])
def test_all_null_columns(rows, probe_rows):
    df = rows("a b c d.e", [("1", None, None, None), ("2", None, "late", None)]).coalesce(1)
    assert columns.all_null_columns(df, probe_rows) == ["b", "d.e"]
    assert columns.drop_all_null_columns(df, probe_rows).columns == ["a", "c"]


def test_all_null_columns_of_an_empty_table(rows):
    assert columns.all_null_columns(rows("a b", []).limit(0)) == ["a", "b"]


def test_completeness(rows):
    names = " ".join(columns.COMPLETENESS_COLUMNS)
    df = columns.with_completeness(rows(names, [
        (None,) * 6, ("",) + (None,) * 5, ("a", "b", "c", None, None, None),
        ("a", "b", "c", "d", None, None), ("a",) * 6]))
    assert [r.completeness for r in df.collect()] == [0.0, 0.167, 0.5, 0.667, 1.0]
    assert [r.completeness for r in filters.filter_complete(df).collect()] == [0.667, 1.0]


def test_country(rows):
    df = rows("countries_tags", [("en:france",), ("en:french-guiana",), ("en:FRANCE",), (None,),
                                 ("en:fr, en:spain",), ("en:belgium,en:fr",)])

    def kept(*args):
        return [r[0] for r in filters.filter_country(df, *args).collect()]
    assert kept("fr") == ["en:france", "en:french-guiana", "en:fr, en:spain", "en:belgium,en:fr"]
    assert kept("fr", "element") == ["en:fr, en:spain", "en:belgium,en:fr"]
    assert kept("f%") == [] and kept("spain", "element") == ["en:fr, en:spain"]
    with pytest.raises(ValueError):
        filters.filter_country(df, "fr", "like")


def test_null_rows_keep_empty_strings(rows):
    df = rows("product_name categories_tags main_category", [("", "", ""), ("a", None, "b"), (None, "a", "b")])
    assert [tuple(r) for r in filters.drop_null_rows(df).collect()] == [("", "", "")]


def test_profiles(rows):
    df = rows("a energy_100g", [("1", None), (None, None), ("3", "x")])
    assert [tuple(r) for r in profiles.null_profile(df).collect()] == [("a", 2), ("energy_100g", 1)]
    assert [tuple(r) for r in profiles.schema_profile(df).collect()] == [
        (0, "a", "string", False, 2), (1, "energy_100g", "string", True, 1)]
    assert profiles.row_count(df).first()[0] == 3
    assert profiles.records(df.orderBy(F.col("a").desc()), 1) == [{"a": "3", "energy_100g": "x"}]
    stats = profiles.completeness_stats(df.select(F.col("a").cast("double").alias("completeness"))).first()
    assert (stats["count"], stats["mean"], stats["min"], stats["max"]) == (2, 2.0, 1.0, 3.0)


def test_stage_counts_agree_with_the_steps(rows):
    names = "code countries_tags product_name generic_name categories_en ingredients_tags" \
            " ingredients_analysis_tags main_category categories_tags"
    data = [("1", "en:france", "a", "b", "c", "d", "e", "en:x", "en:y"),
            ("2", "en:france", "a", "b", "c", "d", "e", "fr:x", "en:y"),
            ("3", "en:france", None, "b", "c", "d", "e", "en:x", "en:y"),
            ("4", "en:france", "a", None, None, None, "e", "en:x", "en:y"),
            ("5", "en:spain", "a", "b", "c", "d", "e", "en:x", "en:y"),
            ("6", None, "a", "b", "c", "d", "e", "en:x", "en:y")]
    got = {r.stage: r.rows for r in profiles.stage_counts(rows(names, data)).collect()}
    assert got == {"all": 6, "country": 4, "complete": 3, "filled": 2, "english": 1}
