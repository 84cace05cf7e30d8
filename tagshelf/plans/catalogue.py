"""The batch job: from a raw catalogue to an embedded one that can be searched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..operators.clusters import cluster_products, nearest_clustered, top_similar_clustered
from ..operators.columns import (drop_all_null_columns, drop_columns_matching, drop_columns_suffix,
                                 drop_null_columns_fixed, drop_unused_columns, with_completeness)
from ..operators.embed import embed_changed, embed_rows, fit_word_model, word_vectors
from ..operators.english import english_only
from ..operators.filters import drop_null_rows, filter_complete, filter_country
from ..operators.lookup import lookup_join
from ..operators.search import query_vectors, recommend, recommend_batch, text_vector, with_display
from ..operators.texts import match_vocabulary, split_ingredients
from ..operators.tokens import process_tokens
from ..sources import (load_word_model, materialize, read_parquet, save_word_model, write_parquet)


def clean(raw: DataFrame, country: str = "fr", threshold: float = 0.5, *,
          match: str = "contains", drop_times: bool = False, drop_empty: bool = False) -> DataFrame:
    """Choose the rows and columns worth searching, everything that needs no join.

    The country filter comes first, since the columns dropped include the ones it reads.
    ``drop_empty`` drops the columns found to hold no value, instead of a fixed list of
    them; that looks at the data in the call.
    """
    df = filter_country(raw, country, match)
    if drop_times:
        df = drop_columns_suffix(df)
    df = drop_all_null_columns(df) if drop_empty else drop_null_columns_fixed(df)
    df = drop_unused_columns(drop_columns_matching(df))
    return drop_null_rows(filter_complete(with_completeness(df), threshold))


def prepare(raw: DataFrame, country: str = "fr", threshold: float = 0.5, *,
            match: str = "contains", drop_times: bool = False, drop_empty: bool = False,
            stop_words: Sequence[str] = ENGLISH_STOP_WORDS, min_partitions: int | None = None) -> DataFrame:
    """``clean``, then only English products, with their ``tokens``.

    The cleaned rows are written once to the shared folder: the English-only
    step reads them twice, and the raw text should be parsed once. They are spread
    over ``min_partitions`` tasks if given, which is for input that few tasks can
    read: what is left by then are the rows and columns worth moving.
    """
    cleaned = clean(raw, country, threshold, match=match, drop_times=drop_times, drop_empty=drop_empty)
    cleaned = materialize(cleaned.repartition(min_partitions) if min_partitions else cleaned)
    return process_tokens(english_only(cleaned), stop_words)


def build(prepared: DataFrame, model_path: str, products_path: str, vectors_path: str, *,
          train: bool = False, centres_path: str | None = None, clusters: int | None = None,
          **training: object) -> Word2VecModel:
    """Embed prepared products and write them as Parquet, with the word vectors beside them.

    The model is loaded from ``model_path``, or trained on the products and
    saved there first; ``training`` is what ``fit_word_model`` takes, which says
    what the driver has to hold. The products are embedded by joining the vectors
    just written, which are broadcast only if they are measured to be small.

    With a ``centres_path`` the products are stored by cluster (``clusters`` of them, see
    ``cluster_products``), and the centres there: searches that get it read only the clusters
    that matter.
    """
    prepared = materialize(prepared)
    if train:
        save_word_model(fit_word_model(prepared, **training), model_path)
    model = load_word_model(model_path)
    write_parquet(word_vectors(model), vectors_path)
    vectors = read_parquet(prepared.sparkSession, vectors_path)
    embedded = embed_rows(prepared, vectors)
    if centres_path is None:
        write_parquet(embedded, products_path)
    else:
        dealt, centres = cluster_products(materialize(embedded), clusters)
        write_parquet(dealt, products_path, by="cluster")
        write_parquet(centres, centres_path)
    return model


def update(prepared: DataFrame, products_path: str, vectors_path: str, new_path: str, *,
           centres_path: str | None = None, clusters: int | None = None, key: str = "url") -> None:
    """Embed a new delivery with the vectors of an earlier ``build`` and write it to ``new_path``.

    The result is that of a whole build with the same model. Rows whose ``key`` and tokens are in
    the products at ``products_path`` take over their embeddings; the others are embedded. Clusters
    are found anew if there is a ``centres_path``.
    """
    if new_path.rstrip("/") == products_path.rstrip("/"):
        raise ValueError("the new products are made from the old ones: write them to another path")
    spark = prepared.sparkSession
    stored = read_parquet(spark, products_path)
    embedded = embed_changed(materialize(prepared), stored, read_parquet(spark, vectors_path), key)
    if centres_path is None:
        write_parquet(embedded, new_path)
    else:
        dealt, centres = cluster_products(materialize(embedded), clusters)
        write_parquet(dealt, new_path, by="cluster")
        write_parquet(centres, centres_path)


def search(spark: SparkSession, text: str, products_path: str, vectors_path: str,
           k: int = 10, *, centres_path: str | None = None, lower: bool = True,
           split_hyphens: bool = True) -> DataFrame:
    """The ``k`` products most similar to ``text`` from what ``build`` wrote.

    By default the text is treated as tokens are: in lower case, split at hyphens.
    """
    products, vectors = read_parquet(spark, products_path), read_parquet(spark, vectors_path)
    if centres_path is None:
        return recommend(products, text, vectors, k, lower=lower, split_hyphens=split_hyphens)
    return top_similar_clustered(products, read_parquet(spark, centres_path),
                                 text_vector(text, vectors, lower, split_hyphens), k)


def search_batch(queries: DataFrame, products_path: str, vectors_path: str, k: int = 10, *,
                 query_key: str = "query_id", text: str = "text", centres_path: str | None = None,
                 lower: bool = True, split_hyphens: bool = True) -> DataFrame:
    """``search`` for a table of queries, with the display columns."""
    spark = queries.sparkSession
    products, vectors = read_parquet(spark, products_path), read_parquet(spark, vectors_path)
    if centres_path is None:
        found = recommend_batch(products, queries, vectors, k, query_key=query_key, text=text, lower=lower,
                                split_hyphens=split_hyphens)
    else:
        asked = query_vectors(queries, vectors, query_key, text, lower, split_hyphens)
        found = nearest_clustered(products, read_parquet(spark, centres_path), asked, k, query_key=query_key)
    return with_display(found, products)


def search_ingredients(texts: DataFrame, products_path: str, vectors_path: str, k: int = 10, *,
                       key: str, text: str = "text") -> DataFrame:
    """``search_batch`` for each ingredient of comma-separated texts: key, ``pos``, ``ingredient``, result.

    An ingredient that occurs in many texts is searched for once.
    """
    parts = split_ingredients(texts, key, text)
    return _with_results(parts.select(key, "pos", "ingredient"), products_path, vectors_path, k)


def search_recipes(recipes: DataFrame, ingredients: DataFrame, products_path: str, vectors_path: str, k: int = 10, *,
                   key: str, text: str = "text") -> DataFrame:
    """``search_batch`` for each known ingredient that free texts mention: key, ``ingredient``, ``count``, result.

    ``ingredients`` (column ``word``) may have several words, see ``match_vocabulary``. One that
    many texts mention is searched for once.
    """
    found = match_vocabulary(recipes, ingredients, [key], text).withColumnRenamed("word", "ingredient")
    return _with_results(materialize(found), products_path, vectors_path, k)


def _with_results(parts: DataFrame, products_path: str, vectors_path: str, k: int) -> DataFrame:
    """Each row with the results for its ``ingredient``, if there are any."""
    asked = parts.select("ingredient").distinct().select("ingredient", F.col("ingredient").alias("text"))
    found = search_batch(asked, products_path, vectors_path, k, query_key="ingredient")
    results = found.groupBy("ingredient").agg(
        F.sort_array(F.collect_list(F.struct("rank", *[c for c in found.columns if c not in ("ingredient", "rank")]))
                     ).alias("results"))
    return lookup_join(parts, results, "ingredient", "inner").select(*parts.columns, F.inline("results"))
