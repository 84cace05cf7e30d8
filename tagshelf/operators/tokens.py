"""From tag strings to the tokens that are embedded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..functions.tags import english_slugs
from ..functions.words import distinct_words, without_stop_words


def add_all_tokens(df: DataFrame) -> DataFrame:
    """Add ``categories_tokens``, ``main_category_tokens`` and their distinct union ``all_tokens``.

    ``all_tokens`` is NULL where either part is.
    """
    parts = df.withColumns({
        "categories_tokens": english_slugs("categories_tags"),
        "main_category_tokens": english_slugs("main_category"),
    })
    both = F.array("categories_tokens", "main_category_tokens")
    return parts.withColumn("all_tokens", F.array_distinct(F.flatten(both)))


def process_tokens(df: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """Add the columns of ``add_all_tokens``, with ``all_tokens`` cut into words, and ``tokens``.

    Words are lower case, distinct and sorted; ``tokens`` leaves out stop words.
    A NULL stays NULL.
    """
    return (add_all_tokens(df).withColumn("all_tokens", distinct_words("all_tokens"))
            .withColumn("tokens", without_stop_words("all_tokens", stop_words)))


def vocabulary(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """The distinct tokens, as column ``word``."""
    # explode_outer, as a plain explode adds a filter that computes the tokens again.
    words = df.select(F.explode_outer(tokens).alias("word"))
    return words.filter(F.col("word").isNotNull()).distinct()
