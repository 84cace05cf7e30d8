"""Keeping the products whose tags are all English."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tags import elements, has_non_english
from .lookup import lookup_join

TAG_COLUMNS = ("main_category", "categories_tags")


def non_english_codes(df: DataFrame) -> DataFrame:
    """The distinct codes of rows with a non-English tag, a NULL code included."""
    return df.filter(_non_english_row()).select("code").distinct()


def english_only(df: DataFrame, **join_options: int) -> DataFrame:
    """Drop every row that shares its code with a row that has a non-English tag.

    A NULL code matches nothing, so rows without a code always stay.

    Rows that are non-English themselves go without a join. A code then matters
    only if it has both an English and a non-English row; those few codes come
    from one aggregate over the code and a flag, and only they are joined with
    the wide rows (``lookup_join``, which takes ``join_options``).
    """
    flags = df.filter(F.col("code").isNotNull()).select("code", _non_english_row().alias("bad"))
    mixed = (flags.groupBy("code").agg(F.max("bad").alias("any_bad"), F.min("bad").alias("all_bad"))
             .filter(F.col("any_bad") & ~F.col("all_bad")).select("code"))
    candidates = df.filter(F.col("code").isNull() | ~_non_english_row())
    return lookup_join(candidates, mixed, "code", "left_anti", **join_options)


def non_english_tags(df: DataFrame, column: str = "categories_tags") -> DataFrame:
    """The trimmed non-English elements left in ``column``, one row each."""
    return (df.select(F.explode(elements(column)).alias("tag")).select(F.trim("tag").alias("tag"))
            .filter(~F.col("tag").startswith("en:")))


def _non_english_row() -> Column:
    first, *rest = [has_non_english(c) for c in TAG_COLUMNS]
    for flag in rest:
        first = first | flag
    return first
