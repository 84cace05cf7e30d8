"""Writing catalogues and word models."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizes import row_bytes


def write_delimited(df: DataFrame, path: str, sep: str = ",", *, quote: str = '"',
                    escape: str = '"', compression: str | None = None,
                    keep_spaces: bool = True, empty_value: str = '""') -> None:
    """Write delimited text with a header row, replacing what is at ``path``.

    A quote inside a value is doubled, and ``read_delimited`` with its own defaults
    reads back what was written, but that an empty value and NULL are one to Spark's
    reader: both come back as NULL. Values with line breaks come back if the file is
    read with ``multi_line=True``. ``keep_spaces=False`` drops blanks around values;
    ``empty_value`` is what stands for an empty one.
    """
    writer = (df.write.mode("overwrite").option("header", True).option("sep", sep)
              .option("quote", quote).option("escape", escape).option("emptyValue", empty_value)
              .option("ignoreLeadingWhiteSpace", not keep_spaces)
              .option("ignoreTrailingWhiteSpace", not keep_spaces))
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, *, by: str | None = None, order: Sequence[str] = (),
                  file_bytes: int | None = None, group_bytes: int | None = None) -> None:
    """Write Parquet, replacing what is at ``path``.

    With ``by`` the rows of one value of that column are in a folder of their own, so a reader that
    asks for some values opens no other file. Rows are moved for that so that a value has few
    files; one with very many rows is split over several tasks (by adaptive execution).

    With ``file_bytes`` the rows are measured and dealt out to as many files as that makes of what
    they take in memory, evenly, however many tasks there were. With ``order`` files take ranges of
    these columns, and rows are sorted in them: a reader that filters by the first of them
    skips the files and row groups (of ``group_bytes``) that can't have a match. One value with
    very many rows is divided over files by the rest of its rows. ``df`` is read several times.
    """
    writer_options = {} if group_bytes is None else {"parquet.block.size": str(group_bytes)}
    if by is not None:
        if order or file_bytes:
            raise ValueError("folders by value have files of their own: leave out order and file_bytes")
        df.hint("rebalance", by).write.mode("overwrite").options(**writer_options).partitionBy(by).parquet(path)
        return
    if file_bytes is not None:
        df = _in_files(df, max(1, math.ceil(row_bytes(df) / file_bytes)), order)
    elif order:
        df = df.sortWithinPartitions(*order)
    df.write.mode("overwrite").options(**writer_options).parquet(path)


def _in_files(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    if not order:
        return df.repartition(n)
    rest = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
    return df.repartitionByRange(n, *order, rest).sortWithinPartitions(*order)


def save_word_model(model: Word2VecModel, path: str) -> None:
    """Save a word model, replacing what is at ``path``."""
    model.write().overwrite().save(path)


def load_word_model(path: str) -> Word2VecModel:
    """Load a word model saved by ``save_word_model`` or by Spark ML itself."""
    return Word2VecModel.load(path)
