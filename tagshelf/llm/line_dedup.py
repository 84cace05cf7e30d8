"""Line dedup: which lines of each document repeat elsewhere, as sparse bitmaps.

DataFrame functions only. Each line becomes a 96-bit hash of its key. The hashes
are range-partitioned with the rows of a hash in order of document and position,
and streamed once; what a stream hands on per hash is a count and the last
document, so no group is ever gathered. A hash is dealt over ``CHUNKS`` ranges by
document, so that a line of a third of all documents is many small streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..sources.scratch import materialize
from .common import WHITE_SPACE, ascii_lower, fresh, text_or_empty

# Ranges that the rows of one hash are dealt over.
CHUNKS = 256
# Bits of one word of a bitmap.
WORD_BITS = 64


def line_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per document that loses a line: (doc_id, text_hash, dropped).

    ``dropped`` is a sparse bitmap: an array of (word, bits) ordered by word, in
    which bit ``i`` of word ``w`` tells that line ``64 * w + i`` goes. Words
    without a dropped line are left out, and so are documents without any: the
    keep bitmap is the complement.

    A line's key is the line without white space at both ends and with A-Z in lower
    case. Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines but those in the largest ``doc_id`` holding them.

    A NULL or empty text is one empty line. Repeated rows (one id, one text) count
    as one document and share a bitmap; rows of one id with different texts have
    a bitmap each (``text_hash`` tells them apart) and count as one document. Rows
    without a ``doc_id`` are documents that come before all others and count as one.
    No documents give no rows. Other columns are not read.
    """
    lines = materialize(_long_lines(docs, min_chars))
    repeated = _last_documents(lines, min_docs)
    marked = lookup_join(lines, repeated, "line", "inner")
    gone = marked.filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    words = (gone.groupBy("doc_id", "text_hash", F.expr(f"pos div {WORD_BITS}").alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pos % {WORD_BITS} as int))")).alias("bits")))
    return words.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text`` cut down to the lines kept, and ``n_lines`` and ``n_dropped`` (long).

    Every row is kept, and a row without dropped lines keeps its text as it is (NULL
    becomes empty). Columns of ``docs`` other than ``doc_id`` and ``text`` pass through;
    ``n_lines`` and ``n_dropped`` are replaced if there already.
    """
    doc, text_hash, dropped, lines = (fresh(docs, name) for name in ("of_doc", "of_text", "dropped", "lines"))
    bitmaps = line_bitmaps(docs, min_chars, min_docs).toDF(doc, text_hash, dropped)
    texts = docs.withColumn("text", text_or_empty())
    both = texts.join(bitmaps, F.col("doc_id").eqNullSafe(F.col(doc))
                      & (F.xxhash64("text") == F.col(text_hash)), "left")
    # A column of its own: a task splits a text once, and then goes by the places of its lines.
    split = both.withColumn(lines, F.split("text", "\n", -1))
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.transform(F.array_except(places, _places(dropped)), lambda place: F.get(lines, place))
    n_dropped = F.aggregate(dropped, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"]))
    return (split.withColumns({"n_lines": F.size(lines).cast("long"),
                               "n_dropped": F.coalesce(n_dropped, F.lit(0).cast("long")),
                               "text": F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))})
            .drop(doc, text_hash, dropped, lines))


def _places(dropped: str) -> Column:
    """The places a sparse bitmap marks."""
    bits = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
    return F.flatten(F.transform(dropped, lambda w: F.transform(
        F.filter(bits, lambda bit: F.getbit(w["bits"], bit) == 1), lambda bit: (w["word"] * WORD_BITS + bit).cast("int"))))


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(line, doc_id, text_hash, pos, chunk) of each line whose key is long enough."""
    text = text_or_empty()
    keys = F.transform(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(WHITE_SPACE)))
    # The text is hashed before its lines are dealt out, or each of them would carry and hash it.
    split = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), keys.alias("keys"))
    rows = split.select("doc_id", "text_hash", F.posexplode("keys").alias("pos", "key"))
    key = ascii_lower(F.col("key"))
    return rows.filter(F.char_length("key") >= min_chars).select(
        F.struct(F.xxhash64(key).alias("a"), F.hash(key).alias("b")).alias("line"),
        "doc_id", "text_hash", "pos", F.pmod(F.xxhash64("doc_id"), F.lit(CHUNKS)).cast("int").alias("chunk"))


def _last_documents(lines: DataFrame, min_docs: int) -> DataFrame:
    """(line, last_doc) of the lines in at least ``min_docs`` documents."""
    stream = Window.partitionBy("line", "chunk").orderBy(F.desc("doc_id"), F.desc("pos"))
    ordered = (lines.select("line", "chunk", "doc_id", "pos").repartitionByRange("line", "chunk")
               .withColumn("before", F.lag(F.struct("doc_id")).over(stream)))
    first = ordered.filter(F.col("before").isNull() | ~F.col("before.doc_id").eqNullSafe(F.col("doc_id")))
    return (first.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
            .filter(F.col("n_docs") >= min_docs).select("line", "last_doc"))
