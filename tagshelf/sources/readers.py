"""Reading catalogues: delimited text (plain or gzip) and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.records import Quoting, range_records, range_states
from .scratch import materialize

# Characters of the longest record whose fields may hold line breaks.
RECORD_CHARS = 64 * 1024 * 1024


def read_delimited(spark: SparkSession, path: str | list[str], sep: str = "\t", *,
                   quote: str = '"', escape: str = '"', multi_line: bool = False,
                   columns: list[str] | None = None,
                   min_partitions: int | None = None) -> DataFrame:
    """Read delimited text with a header row; every column is a string.

    Gzip is recognised by the file name. A gzip file cannot be split, so each is
    read by one task: give ``min_partitions`` to spread the rows right after the
    scan when there are fewer files than that. Where a filter follows, it is less
    work to spread what it leaves.

    A quote inside a field is doubled, as ``write_delimited`` does it; dumps that put
    a backslash before it need ``escape="\\\\"``.

    A field that opens with an unbalanced quote swallows the separators after
    it; pass ``quote=""`` for dumps that do not quote. Fields with line breaks
    need ``multi_line=True``: see ``read_records`` for how a file is then divided.

    ``columns`` names the columns when the header is known, which saves Spark
    the look into the first file.
    """
    if multi_line and quote:
        df = _parsed(spark, path, sep, quote, escape, columns)
    else:
        df = _reader(spark, sep, quote, escape, columns).option("multiLine", multi_line).csv(path)
    return df.repartition(min_partitions) if min_partitions else df


def read_records(spark: SparkSession, path: str | list[str], sep: str = "\t", *,
                 quote: str = '"', escape: str = '"', header: bool = True,
                 record_chars: int = RECORD_CHARS) -> DataFrame:
    """The records of delimited text, unparsed, as ``record``; a quoted field may hold line breaks.

    A file is divided into byte ranges as any text is, and a range can begin within a quoted
    field. One pass finds, per range, where its end lies if its start lies inside or outside of such a
    field; a running composition of these over the ranges of a file tells where each starts. A
    second pass cuts the lines of a range into records. Those that go over the end of a range are
    put together from their fragments; no others are shuffled.

    A line ends with a line feed. Where a record ends with a carriage return before it, that is
    dropped, and its inner line breaks become line feeds alone, as Spark's reader has it. Blank
    records are left out, and so is the first one of each file if it is a ``header``.
    A record of more than ``record_chars`` within one range fails with ``UnclosedQuoteError``: the
    usual reason is a quote that is never closed, and the rest of the file would be one record.
    A quote left open in a shorter rest makes that one record, as it does in Spark's reader,
    without the file's last line feed.
    """
    quoting = Quoting(sep, quote, escape)
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.xxhash64("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start")))
    states = materialize(_starts(lines.mapInArrow(
        range_states(quoting), "file long, start long, from_outside boolean, from_inside boolean, closed boolean")))
    crossed = states.agg(F.bool_or("open")).first()[0]
    # Ranges that start outside are not in the table: it holds one row per record over an end.
    begun = states.filter("inside").select("file", "start", "inside", "owner")
    placed = lines.join(F.broadcast(begun), ["file", "start"], "left").select("value", "file", "start", "inside", "owner")
    cut = placed.mapInArrow(range_records(quoting, header, record_chars),
                            "record string, file long, owner long, place long, first boolean")
    records = cut.filter("owner is null").select("record")
    if crossed:
        pieces = F.transform(F.sort_array(F.collect_list(F.struct("place", "record"))), lambda piece: piece["record"])
        whole = (cut.filter("owner is not null").groupBy("file", "owner")
                 .agg(F.array_join(pieces, "\n").alias("record"), F.bool_or("first").alias("first")))
        records = records.unionByName(whole.filter("not first").select("record"))
    with_return = F.endswith("record", F.lit("\r"))
    bare = F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))
    return records.select(F.when(with_return, bare).otherwise(F.col("record")).alias("record")).filter("record <> ''")


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read Parquet; a single path or several."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def _reader(spark: SparkSession, sep: str, quote: str, escape: str, columns: list[str] | None):
    reader = (spark.read.option("header", True).option("sep", sep)
              .option("quote", quote).option("escape", escape))
    return reader if columns is None else reader.schema(_ddl(columns))


def _ddl(columns: list[str]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "` string" for c in columns)


def _parsed(spark: SparkSession, path: str | list[str], sep: str, quote: str, escape: str,
            columns: list[str] | None) -> DataFrame:
    """The records of ``read_records``, parsed by Spark one by one."""
    if columns is None:
        columns = _reader(spark, sep, quote, escape, None).option("multiLine", True).csv(path).columns
    records = read_records(spark, path, sep, quote=quote, escape=escape)
    options = {"sep": sep, "quote": quote, "escape": escape, "multiLine": "true"}
    return records.select(F.from_csv("record", _ddl(columns), options).alias("parsed")).select("parsed.*")


def _starts(states: DataFrame) -> DataFrame:
    """Whether each range starts ``inside`` of a record, begun in the range ``owner``, and leaves one ``open``.

    The rows are one per byte range, in order of ``start``. A range either sets the state at its
    end whatever it was before, or keeps it, or turns it over: what holds at a start is the
    last state set before, turned over by each such range since.
    """
    file = Window.partitionBy("file").orderBy("start")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("from_outside") == F.col("from_inside")
    turns = F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("long"))
    counted = states.withColumns({"turned": F.coalesce(turns.over(before), F.lit(0)),
                                  "turned_with": turns.over(file.rowsBetween(Window.unboundedPreceding, 0))})
    held = counted.withColumn("last", F.last(F.when(sets, F.struct(F.col("from_outside").alias("state"), "turned_with")),
                                             ignorenulls=True).over(before))
    inside = F.pmod(F.coalesce(F.col("last.state").cast("long"), F.lit(0)) + F.col("turned")
                    - F.coalesce("last.turned_with", F.lit(0)), F.lit(2)) == 1
    known = held.withColumn("inside", inside)
    owner = F.last(F.when(_closes("inside", "closed"), F.col("start")), ignorenulls=True).over(before)
    return known.select("file", "start", "inside", F.when(F.col("inside"), owner).alias("owner"),
                        F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("open"))


def _closes(inside: str, closed: str) -> Column:
    """A range that lies wholly within one record has no record begin in it."""
    return ~F.col(inside) | F.col(closed)
