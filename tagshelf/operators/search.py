"""Similarity search over embedded products.

An embedded product table has ``embedding`` (``array<double>``), ``norm`` and a
unique key column. Search is exact: every product is compared with the query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.blocks import block_scorer, unit_rows
from ..functions.vectors import cosine, percent_text, vector_literal
from ..functions.words import spaced, split_words
from ..sources.scratch import materialize, scratch_path
from .columns import DISPLAY_COLUMNS, select_display
from .embed import mean_vectors, vector_size
from .lookup import lookup_join, small_join

# Bytes of query vectors compared in one pass over the products; the most that is broadcast.
BLOCK_BYTES = 64 * 1024 * 1024
# Digits of a similarity that count when products are ranked.
DIGITS = 6
# Tasks that first merge the candidates of one query.
MERGE_BUCKETS = 64


class UnknownWordsError(ValueError):
    """None of the words of a query has a vector."""


def query_words(queries: DataFrame, key: str = "query_id", text: str = "text",
                lower: bool = True, split_hyphens: bool = False) -> DataFrame:
    """One row per word of each query, repeats kept; a blank query keeps one row with a NULL word.

    ``split_hyphens`` makes words of the parts of a hyphenated one, as tokens are split.
    """
    source = F.lower(text) if lower else F.col(text)
    source = spaced(source) if split_hyphens else source
    return queries.select(key, F.explode_outer(split_words(source)).alias("word"))


def query_vectors(queries: DataFrame, vectors: DataFrame, key: str = "query_id",
                  text: str = "text", lower: bool = True, split_hyphens: bool = False,
                  **join_options: int) -> DataFrame:
    """The mean vector of the known words of each query, as ``key``, ``vector``.

    A repeated word counts each time. Queries without a known word have no row;
    ``query_coverage`` tells which.
    """
    words = query_words(queries, key, text, lower, split_hyphens).filter(F.col("word").isNotNull())
    found = lookup_join(words, vectors.select("word", "vector"), "word", "inner",
                        stored=True, **join_options)
    return mean_vectors(found, [key], vector_size(vectors))


def query_coverage(queries: DataFrame, vocab: DataFrame, key: str = "query_id",
                   text: str = "text", lower: bool = True, split_hyphens: bool = False,
                   **join_options: int) -> DataFrame:
    """How many words of each query are in ``vocab`` (column ``word``, unique) and how many are not."""
    words = query_words(queries, key, text, lower, split_hyphens)
    marked = lookup_join(words, vocab.select("word", F.lit(True).alias("known")), "word", "left",
                         **join_options)
    has_word = F.col("word").isNotNull()
    return marked.groupBy(key).agg(
        F.count_if(has_word & F.col("known").isNotNull()).alias("known_words"),
        F.count_if(has_word & F.col("known").isNull()).alias("unknown_words"))


def text_vector(text: str, vectors: DataFrame, lower: bool = True, split_hyphens: bool = False) -> list[float]:
    """The mean vector of the known words of one query, found in a single job.

    Raises ``UnknownWordsError`` where there is none.
    """
    text = text.replace("-", " ") if split_hyphens else text
    words = (text.lower() if lower else text).split()
    rows = vectors.filter(F.col("word").isin(list(set(words)))).select("word", "vector").collect()
    known = {row["word"]: row["vector"] for row in rows}
    found = [known[word] for word in words if word in known]
    if not found:
        raise UnknownWordsError(f"no word of {text!r} is in the vocabulary")
    return np.mean(found, axis=0).tolist()


def cosine_similarity(df: DataFrame, query: Sequence[float], digits: int | None = DIGITS) -> DataFrame:
    """Add ``similarity`` to the vector ``query``, rounded to ``digits`` if given."""
    length = "norm" if "norm" in df.columns else None
    query_length = F.lit(float(np.linalg.norm(query)))
    similarity = cosine("embedding", vector_literal(query), length, query_length)
    return df.withColumn("similarity", similarity if digits is None else F.round(similarity, digits))


def top_similar(df: DataFrame, query: Sequence[float], k: int = 10, key: str = "url",
                digits: int | None = DIGITS) -> DataFrame:
    """The ``k`` rows most similar to the vector ``query``; equals go by ``key``.

    Rows without an embedding, or with one whose similarity is no number, are left out.
    ``digits=None`` ranks by every bit, the last of which depend on the order of sums.
    """
    return _best(cosine_similarity(df.filter(F.col("embedding").isNotNull()), query, digits), k, key)


def recommend(products: DataFrame, text: str, vectors: DataFrame, k: int = 10, *,
              key: str = "url", lower: bool = True, split_hyphens: bool = False,
              digits: int | None = DIGITS) -> DataFrame:
    """The ``k`` products most similar to the words of ``text``, with all their columns."""
    return top_similar(products, text_vector(text, vectors, lower, split_hyphens), k, key, digits)


def recommend_display(products: DataFrame, text: str, vectors: DataFrame, k: int = 10,
                      digits: int | None = DIGITS) -> DataFrame:
    """``recommend`` as shown to people: the query in lower case, display columns, and a
    percentage, of the similarity before it is rounded."""
    query = text_vector(text, vectors)
    exact = cosine_similarity(products.filter(F.col("embedding").isNotNull()), query, None)
    shown = exact.withColumn("similarity_text", percent_text("similarity"))
    if digits is not None:
        shown = shown.withColumn("similarity", F.round("similarity", digits))
    return select_display(_best(shown, k, "url"), "similarity", "similarity_text")


def recommend_batch(products: DataFrame, queries: DataFrame, vectors: DataFrame, k: int = 10, *,
                    key: str = "url", query_key: str = "query_id", text: str = "text",
                    lower: bool = True, split_hyphens: bool = False, digits: int = DIGITS) -> DataFrame:
    """``recommend`` for a whole table of queries: see ``nearest`` for the result."""
    return nearest(products, query_vectors(queries, vectors, query_key, text, lower, split_hyphens), k,
                   key=key, query_key=query_key, digits=digits)


def nearest(products: DataFrame, queries: DataFrame, k: int = 10, *, key: str = "url",
            query_key: str = "query_id", digits: int = DIGITS, block: int | None = None) -> DataFrame:
    """The ``k`` products nearest to each query vector: query key, ``rank``, key, ``similarity``.

    ``queries`` has a unique ``query_key`` and ``vector``. Blocks of query vectors are
    broadcast, of ``BLOCK_BYTES`` or of ``block`` queries. Each task multiplies
    batches of embeddings with one block and hands on ``k`` products per query and
    batch, never all pairs. Those are merged per query in two steps, so no task sees
    the candidates of all tasks. Similarities are rounded to ``digits`` before they are
    ranked, since the last bits depend on how a batch was cut. Similarities that are no
    numbers are left out.

    The query vectors are computed in the call. One block is then searched when the
    result is read; several are searched in the call, one pass over the products each,
    and their results, at most ``k`` rows a query, are written to the shared folder.
    """
    finite = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = products.filter(finite).select(key, "embedding")
    return _search(usable, materialize(queries.select(query_key, "vector")), k, digits, block)


def with_display(results: DataFrame, products: DataFrame, key: str = "url") -> DataFrame:
    """Add the display columns of the products to search results."""
    shown = products.select(*dict.fromkeys([key, *DISPLAY_COLUMNS]))
    added = [c for c in shown.columns if c not in results.columns]
    return small_join(shown, results, key).select(*results.columns, *added)


def _best(scored: DataFrame, k: int, key: str) -> DataFrame:
    return scored.filter(~F.isnan("similarity")).orderBy(*_best_first(key)).limit(k)


def _best_first(key: str) -> list[Column]:
    return [F.desc("similarity"), F.asc(key)]


def _search(products: DataFrame, queries: DataFrame, k: int, digits: int, block: int | None) -> DataFrame:
    spark = products.sparkSession
    query_field, _ = queries.schema.fields
    key_field = products.schema[0]
    schema = StructType([query_field, key_field, StructField("similarity", DoubleType())])

    def best(rows: Sequence) -> tuple[DataFrame, Broadcast]:
        ids = pa.array([row[0] for row in rows], to_arrow_type(query_field.dataType))
        sent = spark.sparkContext.broadcast((ids, unit_rows(np.array([row[1] for row in rows]))))
        scored = products.mapInArrow(block_scorer(sent, k, digits, schema.names), schema)
        return _best_per_query(scored, query_field.name, key_field.name, k), sent

    rows = queries.toLocalIterator()
    head = list(islice(rows, 1))
    if not head:
        return _best_per_query(spark.createDataFrame([], schema), query_field.name, key_field.name, k)
    blocks = _blocks(chain(head, rows), block or max(1, BLOCK_BYTES // (8 * max(1, len(head[0][1])))))
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return best(first)[0]
    path = scratch_path(spark)
    for part in chain([first, second], blocks):
        found, sent = best(part)
        found.write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(found.schema).parquet(path)


def _blocks(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while block := list(islice(rows, size)):
        yield block


def _best_per_query(scored: DataFrame, query_key: str, key: str, k: int) -> DataFrame:
    bucket = F.pmod(F.spark_partition_id(), F.lit(MERGE_BUCKETS))
    partly = Window.partitionBy(query_key, "_bucket").orderBy(*_best_first(key))
    merged = (scored.withColumn("_bucket", bucket)
              .withColumn("rank", F.row_number().over(partly)).filter(F.col("rank") <= k)
              .drop("_bucket", "rank"))
    wholly = Window.partitionBy(query_key).orderBy(*_best_first(key))
    return (merged.withColumn("rank", F.row_number().over(wholly)).filter(F.col("rank") <= k)
            .select(query_key, "rank", key, "similarity"))
