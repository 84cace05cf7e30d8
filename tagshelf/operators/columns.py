"""Choosing, dropping and computing columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names and name parts of the product catalogue.
NULL_COLUMNS = (
    "cities", "allergens_en", "additives", "nutrition-score-uk_100g",
    "carbohydrates-total_100g",
)
METADATA_PARTS = (
    "origins", "manufacturing_places", "cities", "countries", "owner", "packaging",
    "emb_codes", "states", "100g",
)
TIME_SUFFIXES = ("_t", "_datetime")
UNUSED_COLUMNS = (
    "creator", "last_modified_by", "abbreviated_product_name", "categories", "labels",
    "purchase_places", "stores", "ingredients_text", "allergens", "traces", "traces_en",
    "serving_size", "serving_quantity", "no_nutrition_data", "additives_n", "additives_en",
    "nutriscore_score", "pnns_groups_1", "pnns_groups_2", "food_groups", "food_groups_en",
    "environmental_score_grade", "nutrient_levels_tags", "data_quality_errors_tags",
    "unique_scans_n", "main_category_en", "image_small_url", "image_ingredients_url",
    "image_ingredients_small_url", "image_nutrition_url", "image_nutrition_small_url",
    "popularity_tags", "brands_tags", "brands_en", "traces_tags", "food_groups_tags",
    "completeness",
)
NUTRITION_PART = "100g"
COMPLETENESS_COLUMNS = (
    "product_name", "generic_name", "categories_en", "ingredients_tags",
    "ingredients_analysis_tags", "main_category",
)
DISPLAY_COLUMNS = (
    "url", "product_name", "brands", "nutriscore_grade", "nova_group", "image_url",
)


def drop_null_columns_fixed(df: DataFrame, names: Iterable[str] = NULL_COLUMNS) -> DataFrame:
    """Drop columns known to hold nothing; names that are absent are ignored."""
    return df.drop(*names)


def drop_unused_columns(df: DataFrame, names: Iterable[str] = UNUSED_COLUMNS) -> DataFrame:
    """Drop columns of no use to the search; names that are absent are ignored."""
    return df.drop(*names)


def drop_columns_matching(df: DataFrame, parts: Sequence[str] = METADATA_PARTS) -> DataFrame:
    """Drop every column whose name contains one of ``parts``."""
    return df.drop(*[c for c in df.columns if any(part in c for part in parts)])


def drop_columns_suffix(df: DataFrame, suffixes: Sequence[str] = TIME_SUFFIXES) -> DataFrame:
    """Drop every column whose name ends in one of ``suffixes``."""
    return df.drop(*[c for c in df.columns if c.endswith(tuple(suffixes))])


def all_null_columns(df: DataFrame, probe_rows: int = 1_000) -> list[str]:
    """Names of the columns without a single non-null value.

    A value seen in the first ``probe_rows`` rows settles a column at once, so
    only columns still empty there are counted over the whole table, all in one
    pass that reads nothing but them.
    """
    present = [F.col(f"`{c}`").isNotNull() for c in df.columns]
    seen = df.select(*present).take(probe_rows)
    unsettled = [c for i, c in enumerate(df.columns) if not any(row[i] for row in seen)]
    if not unsettled:
        return []
    counts = df.agg(*[F.count(F.col(f"`{c}`")) for c in unsettled]).first()
    return [c for i, c in enumerate(unsettled) if counts[i] == 0]


def drop_all_null_columns(df: DataFrame, probe_rows: int = 1_000) -> DataFrame:
    """Drop the columns found to hold no value."""
    return df.drop(*all_null_columns(df, probe_rows))


def split_columns(df: DataFrame, part: str = NUTRITION_PART) -> tuple[list[str], list[str]]:
    """The column names that contain ``part``, and the rest."""
    return ([c for c in df.columns if part in c], [c for c in df.columns if part not in c])


def with_completeness(df: DataFrame, columns: Sequence[str] = COMPLETENESS_COLUMNS) -> DataFrame:
    """Add ``completeness``: the share of ``columns`` that are not null, to 3 digits.

    An empty string counts as present.
    """
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return df.withColumn("completeness", F.round(present / F.lit(len(columns)), 3))


def select_display(df: DataFrame, *extra: str) -> DataFrame:
    """The columns shown for a search result, and ``extra`` ones."""
    return df.select(*DISPLAY_COLUMNS, *extra)

