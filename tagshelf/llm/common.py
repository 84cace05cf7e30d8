"""What the operators share: their way of taking words, keys of rows, running Arrow functions."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ArrowFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# The white space of all contracts: [\x20\x09-\x0D]. ``bytes.split()`` uses the same.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def by_value(module: str) -> None:
    """Send the functions of a module to tasks by value, so executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with NULL texts empty; all that a stage's operator reads of its documents."""
    return docs.select("doc_id", text_or_empty().alias("text"))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def giving_back(function: ArrowFunction) -> ArrowFunction:
    """``function``, followed by handing what Arrow has set aside back to the machine.

    A task's Python process is kept for later tasks, and its idle memory counts beside that
    of the JVM.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
    return run


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of a column, value by value; NULL is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
