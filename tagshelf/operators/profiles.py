"""Looking at a table: schema, sizes, missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import in_country
from .columns import NUTRITION_PART, split_columns, with_completeness
from .english import english_only
from .filters import REQUIRED_COLUMNS, filter_complete, drop_null_rows


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null values per column, one row each, from a single pass over the table."""
    columns = df.columns if columns is None else list(columns)
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    return _long(counts, columns, "column", "non_null")


def schema_profile(df: DataFrame, part: str = NUTRITION_PART) -> DataFrame:
    """Position, name, type and non-null values of each column, and whether its name has ``part``."""
    matching, _ = split_columns(df, part)
    about = F.create_map(*[F.lit(x) for i, (name, kind) in enumerate(df.dtypes)
                           for x in (name, f"{i}:{kind}")])
    info = F.split(about[F.col("column")], ":", 2)
    return null_profile(df).select(
        info[0].cast("bigint").alias("position"), "column", info[1].alias("data_type"),
        F.col("column").isin(matching).alias("is_nutrition"), "non_null")


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a table of one row."""
    return df.agg(F.count("*").alias("rows"))


def stage_counts(df: DataFrame, country: str = "fr", threshold: float = 0.5, *,
                 match: str = "contains") -> DataFrame:
    """Rows left after each cleaning step, in order.

    The steps that look at one row at a time are counted together in one pass;
    the last one needs the join of ``english_only``.
    """
    scored = with_completeness(df)
    chosen = F.coalesce(in_country(F.col("countries_tags"), country, match), F.lit(False))
    complete = chosen & (F.col("completeness") > threshold)
    filled = complete
    for column in REQUIRED_COLUMNS:
        filled = filled & F.col(column).isNotNull()
    steps = {"all": F.lit(True), "country": chosen, "complete": complete, "filled": filled}
    counts = scored.agg(*[F.count_if(test).alias(f"c{i}") for i, test in enumerate(steps.values())])
    by_row = _long(counts, list(steps), "stage", "rows")
    english = english_only(drop_null_rows(filter_complete(scored.filter(chosen), threshold)))
    return by_row.unionByName(row_count(english).select(F.lit("english").alias("stage"), "rows"))


def completeness_stats(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, least and greatest ``completeness``, as one row."""
    c = F.col("completeness")
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev(c).alias("stddev"),
                  F.min(c).alias("min"), F.max(c).alias("max"))


def preview(df: DataFrame, n: int = 20, order: Sequence[str] = ()) -> DataFrame:
    """``n`` rows: any, which reads no more than it needs, or the first by ``order``."""
    return (df.orderBy(*order) if order else df).limit(n)


def records(df: DataFrame, limit: int) -> list[dict]:
    """At most ``limit`` rows as dictionaries on the driver."""
    return [row.asDict() for row in df.limit(limit).collect()]


def _long(counts: DataFrame, names: Sequence[str], name_column: str, value_column: str) -> DataFrame:
    """Turn the one row of ``counts`` into a row per name."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name_column), F.col(f"c{i}").alias(value_column))
                      for i, n in enumerate(names)])
    return counts.select(F.inline(pairs))
