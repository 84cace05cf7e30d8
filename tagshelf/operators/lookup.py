"""Joining a big table to a table with unique keys, whatever the size and the skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from ..sources.sizes import row_bytes, size_of_rows

# The lookup side is broadcast up to this many bytes of its rows.
BROADCAST_BYTES = 128 * 1024 * 1024
# A key with this many rows or more on the big side is spread, so that no task gets more
# than about as many of them.
HOT_ROWS = 1_000_000
# The table of frequent keys is broadcast up to this size; beyond it Spark chooses.
HOT_TABLE_BYTES = 16 * 1024 * 1024


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, how: str = "inner", *,
                stored: bool = False, broadcast_bytes: int = BROADCAST_BYTES,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join ``df`` to ``lookup`` on ``key``, which is unique in ``lookup``.

    ``how`` is a join that decides each row of ``df`` by itself: inner, left,
    left_semi or left_anti.

    ``lookup`` is written out and measured on the way, or only measured if it is
    ``stored``, that is, cheap to read twice. A small one is broadcast, so the
    big side is not shuffled at all. Otherwise both are shuffled on the key; a key
    with ``hot_rows`` rows or more is spread over as many salts as that makes
    portions of its rows, and rows whose key is NULL and can match nothing over
    the shuffle's partitions.
    """
    lookup, size = (lookup, row_bytes(lookup)) if stored else _written(lookup)
    if size <= broadcast_bytes:
        joined = df.join(F.broadcast(lookup), key, how)
    else:
        joined = _salted_join(df, lookup, key, how, hot_rows, broadcast_bytes)
    added = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c != key]
    return joined.select(*df.columns, *added)


def small_join(df: DataFrame, few: DataFrame, key: str, *,
               broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``df``, where ``key`` is unique, with a table expected to have few rows.

    ``few`` may repeat keys. It is broadcast if its real size allows; otherwise
    the rows of its frequent keys are spread as in ``lookup_join``.
    """
    few, size = _written(few)
    if size <= broadcast_bytes:
        return df.join(F.broadcast(few), key)
    return _salted_join(few, df, key, "inner", hot_rows, broadcast_bytes).drop("_salt")


def _written(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder, and its ``row_bytes`` seen while writing."""
    seen = Observation()
    table = materialize(df.observe(seen, size_of_rows(df).alias("bytes")))
    return table, seen.get["bytes"] or 0


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Every key with at least ``hot_rows`` rows, and the ``_salts`` its rows are spread over.

    There are at most rows / ``hot_rows`` of them.
    """
    return (df.filter(F.col(key).isNotNull()).groupBy(key).count()
            .filter(F.col("count") >= hot_rows)
            .select(key, F.ceil(F.col("count") / hot_rows).alias("_salts")))


def _salted_join(df: DataFrame, lookup: DataFrame, key: str, how: str,
                 hot_rows: int, broadcast_bytes: int) -> DataFrame:
    hot, size = _written(hot_keys(df, key, hot_rows))
    if size <= broadcast_bytes or size <= HOT_TABLE_BYTES:
        hot = F.broadcast(hot)
    # The salt depends on the task alone, so a task that runs again after a loss sends its
    # rows to the same places; and full copies of a row still spread. A task's own rows of
    # a key stay together: they are no more than one task has read.
    nulls = F.lit(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salts = F.when(F.col(key).isNull(), nulls).otherwise(F.coalesce("_salts", F.lit(1))).cast("int")
    left = (df.join(hot, key, "left")
            .withColumn("_salt", F.pmod(F.spark_partition_id(), salts)).drop("_salts"))
    right = (lookup.join(hot, key, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)).cast("int") - 1)))
             .drop("_salts"))
    return left.join(right, [key, "_salt"], how)
