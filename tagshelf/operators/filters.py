"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import in_country

REQUIRED_COLUMNS = ("product_name", "categories_tags", "main_category")


def filter_country(df: DataFrame, country: str, match: str = "contains") -> DataFrame:
    """Keep rows whose ``countries_tags`` name ``country``; see ``functions.tags.in_country``."""
    return df.filter(in_country("countries_tags", country, match))


def filter_complete(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Keep rows whose ``completeness`` is above ``threshold`` (strictly)."""
    return df.filter(F.col("completeness") > threshold)


def drop_null_rows(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows with a NULL in any of ``columns``; empty strings stay."""
    return df.na.drop(subset=list(columns))
