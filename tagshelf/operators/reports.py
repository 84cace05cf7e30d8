"""Frequency reports.

Counts are partial per task before they are shuffled, so a value held by a large
part of all rows costs no more than any other. Every order has a tie-break, so
reports are the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import elements
from ..functions.words import ascii_name_words


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column`` (NULL is a value), most frequent first."""
    return _most_frequent(df.groupBy(column).count(), column)


def count_by_country(df: DataFrame) -> DataFrame:
    """Rows per country tag string."""
    return count_by(df, "countries_tags")


def count_by_nutriscore(df: DataFrame) -> DataFrame:
    """Rows per nutri-score grade."""
    return count_by(df, "nutriscore_grade")


def count_by_nova(df: DataFrame) -> DataFrame:
    """Rows per NOVA group."""
    return count_by(df, "nova_group")


def explode_tags(df: DataFrame, key: str = "url", column: str = "categories_tags") -> DataFrame:
    """One row per tag: the key, the position from 0, and the tag untrimmed."""
    return df.select(key, F.posexplode(elements(column)).alias("pos", "tag"))


def top_categories(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent category tags."""
    tags = df.select(F.explode(elements("categories_tags")).alias("category"))
    return count_by(tags, "category").limit(k)


def top_main_categories(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent main categories."""
    return count_by(df, "main_category").limit(k)


def top_name_words(df: DataFrame, k: int = 30, column: str = "product_name") -> DataFrame:
    """The ``k`` most frequent words of three letters or more in product names.

    The words consist of a-z alone, so their length is all there is to test.
    """
    words = df.select(F.explode(ascii_name_words(column)).alias("word"))
    return count_by(words.filter(F.length("word") >= 3), "word").limit(k)


def tag_count_histogram(df: DataFrame) -> DataFrame:
    """Rows per number of category tags; rows without tags count under NULL."""
    number = F.size(elements("categories_tags"))
    return (df.select(F.when(F.col("categories_tags").isNotNull(), number).alias("num_categories"))
            .groupBy("num_categories").count().orderBy("num_categories"))


def _most_frequent(counts: DataFrame, column: str) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.asc_nulls_first(column))
