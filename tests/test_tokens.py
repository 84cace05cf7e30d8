from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagshelf.functions.stopwords import ENGLISH_STOP_WORDS
from tagshelf.functions.words import strip, without_stop_words
from tagshelf.operators import reports, texts, tokens

NAMES = "categories_tags main_category"


def test_slugs_of_tags(rows):
    df = tokens.add_all_tokens(rows(NAMES, [
        ("en:a, en:b", "en:c"), ("en:chicken:thigh", "en:a,fr:b,en:a"), (None, "en:a"), ("", "fr:b")]))
    assert [tuple(r)[2:] for r in df.collect()] == [
        (["a"], ["c"], ["a", "c"]), (["chickthigh"], ["a", "a"], ["chickthigh", "a"]),
        (None, ["a"], None), ([], [], [])]


def test_words_of_tokens(rows):
    df = rows(NAMES, [("en:fresh-meats,en:Plant based", "en:meats"), (None, "en:a"),
                      ("en:no break\x1cspace", "en:the-and")])
    got = tokens.process_tokens(df, ["based", "the"]).select("all_tokens", "tokens").collect()
    assert [tuple(r) for r in got] == [
        (["based", "fresh", "meats", "plant"], ["fresh", "meats", "plant"]), (None, None),
        (["and", "break", "no", "space", "the"], ["and", "break", "no", "space"])]
    assert [r.tokens for r in tokens.process_tokens(df).collect()][2] == ["break", "space"]
    assert sorted(r.word for r in tokens.vocabulary(tokens.process_tokens(df)).collect()) == [
        "based", "break", "fresh", "meats", "plant", "space"]


def test_no_stop_words(rows):
    df = rows("w", [("the",), ("i'll",), ("a\\b",), ("x",)]).select(F.array("w").alias("w"))
    assert [r[0] for r in df.select(without_stop_words("w", [])).collect()] == [["the"], ["i'll"], ["a\\b"], ["x"]]
    stops = ["i'll", "a\\b", "the"]
    assert [r[0] for r in df.select(without_stop_words("w", stops)).collect()] == [[], [], [], ["x"]]
    assert len(ENGLISH_STOP_WORDS) == len(set(ENGLISH_STOP_WORDS)) == 181


def in_python(categories, main):
    """The token steps, said in Python."""
    if categories is None or main is None:
        return None
    slugs = [t.replace("en:", "") for tags in (categories, main) for t in tags.split(",") if t.startswith("en:")]
    words = {w for slug in slugs for w in slug.replace("-", " ").lower().split()}
    return sorted(words - set(ENGLISH_STOP_WORDS))


tag = st.text(alphabet="abTHE-:   \t\x1fé", max_size=8)
tags = st.none() | st.lists(st.sampled_from(["en:", "fr:", " en:", ""]).flatmap(
    lambda lang: tag.map(lambda t: lang + t)), min_size=1, max_size=4).map(",".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(tags, tags), min_size=1, max_size=30))
def test_tokens_as_in_python(rows, data):
    got = tokens.process_tokens(rows(NAMES, data)).collect()
    want = [(c, m, in_python(c, m)) for c, m in data]
    assert sorted(((r.categories_tags, r.main_category, r.tokens) for r in got), key=repr) == sorted(want, key=repr)


def test_strip(rows):
    df = rows("t", [(" \t\n a b\x1f ",), ("   ",), ("",)])
    assert [r[0] for r in df.select(strip("t")).collect()] == ["a b", "", ""]


def test_name_words(rows):
    df = rows("product_name", [(" Crème brûlée  2-pack",), ("PACK pack to",), (None,)])
    assert [tuple(r) for r in reports.top_name_words(df).collect()] == [("pack", 3), ("brle", 1), ("crme", 1)]
    assert reports.top_name_words(df, 1).count() == 1


def test_reports(rows):
    df = rows("url categories_tags", [("1", "en:a, en:b"), ("2", ""), ("3", None), ("4", "en:a")])
    assert [tuple(r) for r in reports.tag_count_histogram(df).collect()] == [(None, 1), (1, 2), (2, 1)]
    assert [tuple(r) for r in reports.top_categories(df, 2).collect()] == [("en:a", 2), ("", 1)]
    assert [tuple(r) for r in reports.explode_tags(df).orderBy("url", "pos").collect()] == [
        ("1", 0, "en:a"), ("1", 1, " en:b"), ("2", 0, ""), ("4", 0, "en:a")]
    assert [tuple(r) for r in reports.count_by(df.selectExpr("null as x", "url"), "x").collect()] == [(None, 4)]


def test_ingredients(rows):
    df = rows("id text", [("1", " Flour,\n SUGAR ,,  ,salt"), ("2", None), ("3", " ")])
    assert [tuple(r) for r in texts.split_ingredients(df, "id").collect()] == [
        ("1", 0, "flour"), ("1", 1, "sugar"), ("1", 4, "salt")]


def test_vocabulary_in_texts(shuffled_joins, rows):
    df = rows("id text", [("1", "Salt, sea-salt; SALT!"), ("2", "pâté et sel"), ("3", None)])
    vocab = rows("word", [("salt",), ("salt",), ("pâté",), ("pepper",)])
    for options in ({}, {"broadcast_bytes": -1, "hot_rows": 2}):
        found = texts.match_vocabulary(df, vocab, ["id"], **options).orderBy("id").collect()
        assert [tuple(r) for r in found] == [("1", "salt", 3), ("2", "pâté", 1)]
