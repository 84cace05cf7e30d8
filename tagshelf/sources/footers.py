"""Counts of stored Parquet tables from the footers of their files, without reading a column."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Spark pushes aggregates down to the Parquet reader of its newer source interface only.
_PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
_LONG = (StringType, BinaryType, ArrayType, MapType, StructType)


def stored_counts(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """The number of rows of a stored table, and that of the values that are not NULL by column.

    The files' footers tell both, so what is read does not grow with the rows. Writers leave
    them out for columns with very long values: where those of strings, bytes or nested values are
    missing, these columns are read. The counts are the same.
    """
    plain = spark.read.parquet(path)
    columns = plain.columns if columns is None else list(columns)
    fixed = [c for c in columns if not isinstance(plain.schema[c].dataType, _LONG)]
    others = [c for c in columns if c not in fixed]
    rows, filled = _by_footers(spark, path, fixed)
    if others:
        try:
            filled |= _by_footers(spark, path, others)[1]
        except (PySparkException, Py4JJavaError):
            filled |= dict(zip(others, _counts(plain, others).first()[1:]))
    return rows, {c: filled[c] for c in columns}


def _by_footers(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    with _settings(spark, _PUSHED):
        # The sum over no footer at all is NULL.
        rows, *filled = (n or 0 for n in _counts(spark.read.parquet(path), columns).first())
    return rows, dict(zip(columns, filled))


def stored_null_profile(spark: SparkSession, path: str) -> DataFrame:
    """``null_profile`` of a stored table, from its footers: (column, non_null)."""
    _, filled = stored_counts(spark, path)
    return spark.createDataFrame(list(filled.items()), "column string, non_null long")


def read_filled_columns(spark: SparkSession, path: str) -> DataFrame:
    """A stored table without the columns that hold no value; no rows are read to find them."""
    _, filled = stored_counts(spark, path)
    table = spark.read.parquet(path)
    return table.drop(*[c for c, n in filled.items() if n == 0])


def counting_plan(spark: SparkSession, path: str) -> str:
    """The plan of ``stored_counts`` as text, to see whether it is answered by footers."""
    with _settings(spark, _PUSHED):
        table = spark.read.parquet(path)
        return _counts(table, table.columns)._jdf.queryExecution().toString()


def _counts(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("rows"),
                     *[F.count(F.col("`" + c.replace("`", "``") + "`")).alias(f"c{i}") for i, c in enumerate(columns)])


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
