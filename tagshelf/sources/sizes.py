"""What the rows of a table take in memory, told from their values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType


def row_bytes(df: DataFrame) -> int:
    """What the rows of ``df`` take in memory, rounded up."""
    return df.agg(size_of_rows(df)).first()[0] or 0


def size_of_rows(df: DataFrame) -> Column:
    return F.sum(sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(32)))


def _width(column: Column, kind: DataType) -> Column:
    """Bytes of one value in a row; 16 for anything of fixed width."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        inner = kind.elementType
        if isinstance(inner, (StringType, BinaryType, ArrayType, MapType, StructType)):
            items = F.octet_length(F.to_json(column)) + 16 * F.size(column)
        else:
            items = 8 * F.size(column)
        return F.coalesce(items, F.lit(0)) + 32
    if isinstance(kind, (MapType, StructType)):
        return 4 * F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 64
    return F.lit(16)
