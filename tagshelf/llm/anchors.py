"""Finding repeated windows of a fixed length without sorting every position of the corpus.

Every window of ``length`` symbols (words or bytes) has an anchor: its gram of ``gram``
symbols with the smallest hash, the last of equals. Equal windows have the same anchor
at the same place, so they meet if windows are dealt out by their anchors. Consecutive
windows with one anchor are a run, and the text that a run's windows cover is its span.

1. Runs are range-partitioned by anchor hash, document and place, so that an anchor
   found everywhere is spread, and streamed: a run whose anchor has no neighbour is
   alone in the corpus, and so are all its windows.
2. Equal spans among the other runs are one class, with its count and its smallest
   document, before any text is shuffled.
3. Besides its anchor a window holds, before the anchor or behind it, half of its other
   symbols at least. So a class whose text beside the anchor, so far on either side, is that of no
   other class of the anchor has no equal window in any, and drops out by its hashes.
   Of the other classes one text each is compared by an algorithm on suffixes (a suffix
   tree or a sorted suffix array), which tells which windows of different classes are equal.
4. An anchor of very many classes is divided first: its windows by how deep the anchor
   lies in them, into two halves, and each half by the text that all its windows hold
   around the anchor. What is equal then is one class again, and parts that are still
   too large are divided in the same way, until all fit. At the last a part holds one
   window, which is one class.
5. Each run takes the result of its class, each document those of its runs.

Nothing is left out: steps 1 and 3 only drop what cannot have an equal window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from ..sources.scratch import materialize
from .common import ArrowFunction, by_value, giving_back, text_or_empty, texts_of

by_value(__name__)

# Symbols handled at once, and the longest piece of one document among them. Pieces of a
# document overlap by a window; their places in a block take PLACE_BITS.
BLOCK, PIECE, PLACE_BITS = 1 << 18, 1 << 18, 20
# Text of the spans that a task compares at once; an anchor's spans stay together.
COMPARED_BYTES = 1 << 20
# Spans of one anchor that are compared without being divided.
GROUP_SPANS = 2000
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Stands for a NULL doc_id, which is smaller than any other.
NO_ID = -(2 ** 63)


class Alphabet(NamedTuple):
    """How texts become symbols; ``hashes`` gives a 64-bit hash of each symbol of a text,
    ``piece`` the bytes of the symbols from one place to another; ``block`` is how many are handled at once."""

    length: int
    gram: int
    hashes: Callable[[bytes], np.ndarray]
    piece: Callable[[bytes, Sequence[tuple[int, int]]], list[bytes]]
    block: int = BLOCK


class Spans(NamedTuple):
    """Spans compared at once: per span the number of its anchor, the place of the anchor, its
    number of windows, the smallest document of its class, and its text."""

    anchor: np.ndarray
    place: np.ndarray
    windows: np.ndarray
    least: np.ndarray
    alone: np.ndarray
    texts: list[bytes]


# Tells which windows go: a boolean per window, span after span.
Compare = Callable[[Spans], np.ndarray]


# The texts are shuffled once, compressed: all that is joined to them meets them by ``doc``
# alone and takes all their columns, so that Spark finds the exchanges equal.
ROW = ("doc_id", "doc", "row", "packed")


def rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, row, text); ``row`` tells apart rows of one id."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return (docs.select("doc_id", doc.alias("doc"), text_or_empty().alias("text"))
            .select("doc_id", "doc", F.hash("text").alias("row"), "text"))


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with the texts compressed, the columns ``ROW``."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_packer, f"doc_id {kind}, " + _schema("doc long, row int, packed binary"))


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(3).compress
    for batch in batches:
        texts = pa.array([squeeze(t) for t in texts_of(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], texts], list(ROW))


def unpacked(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The texts of a batch with the columns ``ROW``."""
    return map(zstandard.ZstdDecompressor().decompress, batch.column(3).to_pylist())


def repeated_windows(rows: DataFrame, shuffled: DataFrame, alphabet: Alphabet, compare: Compare, *, whole: Column, worth: Column) -> DataFrame:
    """(doc, gone array<struct<row, ranges>>): the windows of each document to go, as ranges
    array<struct<start, windows>> for each of its rows, in any order and number.

    ``shuffled`` is ``packed(rows)``, which the result is to be joined to.

    ``whole`` is a condition on ``doc`` (of a run), ``least`` and ``n`` (smallest document and
    count of its class) under which all windows of the run go; the others go by what
    ``compare`` says of their class. ``worth`` is an aggregate over the classes of an anchor
    (with ``least`` and ``n``) telling whether there is anything to compare.
    """
    runs = rows.select("doc", "text").mapInArrow(_scanner(alphabet), "key long, doc long, pos int")
    near = materialize(runs.repartitionByRange("key", "doc", "pos").sortWithinPartitions("key")
                       .mapInArrow(_neighbours(GROUP_SPANS), "doc long, pos int, key long, runs long"))
    wanted = near.filter("key is null").groupBy("doc").agg(F.collect_set("pos").alias("wanted"))
    found = (shuffled.join(wanted, "doc").select(*ROW, "wanted")
             .mapInArrow(_chooser(alphabet),
                         _schema("key long, span long, doc long, row int, pos int, windows int, place int")
                         + ", before long, behind long"))
    # Only an anchor of so many runs can have so many classes.
    many = near.filter("key is not null").groupBy("key").agg(F.sum("runs").alias("runs")).filter(
        F.col("runs") > GROUP_SPANS).select("key")
    crowded = not many.isEmpty()
    if crowded:
        found = materialize(found)
    # All that is made of the classes uses both columns, so they are aggregated once.
    classes = found.groupBy("key", "span").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "row", "pos", "windows", "place")).alias("first"),
        F.any_value("before").alias("before"), F.any_value("behind").alias("behind"))
    if crowded:
        classes = materialize(classes)
    compared = _with_partners(classes, worth)
    if crowded:
        compared = materialize(compared)

    def fetched(classes: DataFrame) -> DataFrame:
        asked = (classes.select("key", "span", "n", "first.*").groupBy("doc")
                 .agg(F.collect_list(F.struct("row", "key", "span", "doc", "n", "pos", "windows", "place")).alias("asked")))
        return shuffled.join(asked, "doc").select(*ROW, "asked").mapInArrow(
            _fetcher(alphabet), _schema("key long, span long, doc long, n long, windows int, place int, piece binary"))

    large = _large(compared.groupBy("key").agg(F.count(F.lit(1)).alias("classes"))) if crowded else None
    if large is None:
        ranges = _compared(fetched(compared), compare)
    else:
        divided = fetched(compared.join(F.broadcast(large), "key", "left_semi")).withColumns(
            {"low": F.lit(0), "high": F.lit(alphabet.length - alphabet.gram + 1)})
        ranges = _compared(fetched(compared.join(F.broadcast(large), "key", "left_anti")), compare).unionByName(
            _divided(divided, alphabet, compare, whole, worth))
    told = classes.join(ranges, ["key", "span"], "left").select(
        "key", "span", "n", F.col("first.doc").alias("least"), "ranges")
    return (_decided(found, told, ("doc", "row"), "pos", whole)
            .select("doc", F.struct("row", "ranges").alias("gone"))
            .groupBy("doc").agg(F.collect_list("gone").alias("gone")))


def _with_partners(classes: DataFrame, worth: Column) -> DataFrame:
    """The classes that share the text before or behind their anchor with another one."""
    sides = classes.select("key", "span", "n", F.struct(F.col("first.doc").alias("doc")).alias("first"),
                           F.explode(F.array("before", "behind")).alias("side")).filter("side is not null")
    paired = sides.groupBy("side").agg(F.count(F.lit(1)).alias("classes"), worth.alias("worth")).filter(
        "classes > 1 and worth")
    # By a name of its own, so that a side that very many classes have can be split, as in _decided.
    name = F.xxhash64("side").alias("name")
    partners = (sides.select("key", "span", name).join(paired.select(name), "name", "left_semi")
                .select("key", "span").distinct())
    return classes.join(partners, ["key", "span"], "left_semi")


def _decided(members: DataFrame, told: DataFrame, names: Sequence[str], at: str, whole: Column) -> DataFrame:
    """(``names``, ranges) of the members of the classes in ``told``, moved by the column ``at``."""
    every = F.array(F.struct(F.lit(0).alias("start"), F.col("windows").alias("windows")))
    # A class of its own name, so that both sides come from plain exchanges: of such Spark
    # can split a partition that holds a class of very many runs.
    name = F.xxhash64("key", "span").alias("class")
    decided = (members.select("*", name).join(told.select("*", name), ["class", "key", "span"])
               .select(*names, at, F.when(whole, every).otherwise(F.col("ranges")).alias("ranges"))
               .filter(F.size("ranges") > 0))
    moved = F.transform("ranges", lambda r: F.struct(
        (r["start"] + F.col(at)).alias("start"), r["windows"].alias("windows")))
    return decided.select(*names, moved.alias("ranges"))


RANGES = "ranges array<struct<start:int,windows:int>>"


def _compared(texts: DataFrame, compare: Compare) -> DataFrame:
    """(key, span, ranges): what ``compare`` says of the texts of each key."""
    return (texts.repartition("key").sortWithinPartitions("key", "span")
            .mapInArrow(_comparer(compare), _schema(f"key long, span long, {RANGES}")))


def _large(several: DataFrame) -> DataFrame | None:
    """The keys of more than ``GROUP_SPANS`` classes, if there are any."""
    large = materialize(several.filter(F.col("classes") > GROUP_SPANS).select("key"))
    return None if large.isEmpty() else large


def _divided(texts: DataFrame, alphabet: Alphabet, compare: Compare, whole: Column, worth: Column) -> DataFrame:
    """(key, span, ranges) of texts whose keys have too many to be compared at once.

    ``low`` and ``high`` bound how deep the anchor lies in the windows of a key.
    """
    pieces = materialize(texts.mapInArrow(
        _divider(alphabet), "in_key long, in_span long, doc long, count long, at int, key long, span long, "
                            "windows int, place int, low int, high int, piece binary"))
    classes = materialize(pieces.groupBy("key", "span").agg(
        F.sum("count").alias("n"), F.struct(F.min("doc").alias("doc")).alias("first"),
        *[F.first(c).alias(c) for c in ("windows", "place", "low", "high", "piece")]))
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), worth.alias("worth")).filter(
        "classes > 1 and worth")
    large = _large(several)
    rest = classes.join(several.select("key"), "key", "left_semi").select(
        "key", "span", "first.doc", "n", "windows", "place", "piece", "low", "high")
    if large is None:
        ranges = _compared(rest.drop("low", "high"), compare)
    else:
        ranges = _compared(rest.join(F.broadcast(large), "key", "left_anti").drop("low", "high"), compare).unionByName(
            _divided(rest.join(F.broadcast(large), "key", "left_semi"), alphabet, compare, whole, worth))
    told = classes.join(ranges, ["key", "span"], "left").select(
        "key", "span", "n", F.col("first.doc").alias("least"), "ranges")
    members = pieces.select("in_key", "in_span", "doc", "at", "key", "span", "windows")
    return (_decided(members, told, ("in_key", "in_span"), "at", whole)
            .groupBy(F.col("in_key").alias("key"), F.col("in_span").alias("span"))
            .agg(F.flatten(F.collect_list("ranges")).alias("ranges")))


def _schema(columns: str) -> str:
    """Columns that are never NULL, so that joins add no filters by which equal steps would differ."""
    return ", ".join(f"{c} not null" for c in columns.split(", "))


# ---- runs ------------------------------------------------------------------

class Runs(NamedTuple):
    owner: np.ndarray
    pos: np.ndarray
    windows: np.ndarray
    place: np.ndarray
    key: np.ndarray
    span: np.ndarray
    before: np.ndarray
    behind: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    back = np.uint64(pow(int(_STEP), -1, 2 ** 64))
    factors = np.ones((2, n + 1), np.uint64)
    factors[0, 1:], factors[1, 1:] = _STEP, back
    up, down = np.multiply.accumulate(factors, axis=1)
    return up, down


_UP, _DOWN = _powers(0)


def blocks(hashes: Iterator[np.ndarray], length: int, most: int = BLOCK) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Documents in blocks of pieces (number of the document, place in it, symbols)."""
    block, size = [], 0
    for owner, symbols in enumerate(hashes):
        for start in range(0, max(1, len(symbols) - length + 1), PIECE):
            piece = symbols[start:start + PIECE + length - 1]
            if len(piece) < length:
                continue
            block.append((owner, start, piece))
            size += len(piece)
            if size >= most:
                yield block
                block, size = [], 0
    if block:
        yield block


def runs_of(block: list[tuple[int, int, np.ndarray]], length: int, gram: int) -> Runs:
    """The runs of a block's pieces."""
    global _UP, _DOWN
    symbols = np.concatenate([piece for _, _, piece in block])
    n = len(symbols)
    if len(_UP) <= n + 1:
        _UP, _DOWN = _powers(2 * n + 2)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * _UP[:n], dtype=np.uint64)))
    grams = mixed((sums[gram:] - sums[:-gram]) * _DOWN[:n - gram + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    width, size = length - gram + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:size - width], least[width - size:])
    anchor = (low - (least & low)).astype(np.int64)
    sizes = np.array([len(piece) for _, _, piece in block])
    ends = np.cumsum(sizes)
    piece_of = np.repeat(np.arange(len(block)), sizes)[:len(anchor)]
    valid = np.arange(len(anchor)) + length <= ends[piece_of]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(new & valid)
    stops = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    windows = stops - starts
    ends_of_span = starts + windows - 1 + length
    place = anchor[starts] - starts
    span = (sums[ends_of_span] - sums[starts]) * _DOWN[starts]
    span = mixed(span ^ mixed((windows << PLACE_BITS | place).astype(np.uint64)))
    # The text beside the anchor, half of a window's other symbols; 0 where the span has less.
    half, at = (length - gram + 1) // 2, anchor[starts]
    before = _beside(sums, at - half, at, place >= half, 1)
    behind = _beside(sums, at + gram, at + gram + half, length - gram - place + windows - 1 >= half, 2)
    which = piece_of[starts]
    owners, offsets = np.array([b[0] for b in block]), np.array([b[1] for b in block])
    return Runs(owners[which], starts - (ends - sizes)[which] + offsets[which], windows, place,
                grams[anchor[starts]], span, *(np.where(s, mixed(s ^ mixed(grams[at])), 0) for s in (before, behind)))


def _beside(sums: np.ndarray, start: np.ndarray, stop: np.ndarray, there: np.ndarray, side: int) -> np.ndarray:
    start, stop = np.where(there, start, 0), np.where(there, stop, 0)
    text = mixed((sums[stop] - sums[start]) * _DOWN[start] + np.uint64(side))
    return np.where(there, text | np.uint64(1), np.uint64(0))


def _scanner(alphabet: Alphabet) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for block in blocks(map(alphabet.hashes, texts_of(batch)), alphabet.length, alphabet.block):
                r = runs_of(block, alphabet.length, alphabet.gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.key.view(np.int64)), pa.array(docs[r.owner]), pa.array(r.pos.astype(np.int32))],
                    ["key", "doc", "pos"])
    return giving_back(run)


def _neighbours(many: int) -> ArrowFunction:
    """Rows with the key of the row before or after; those at either end of a partition, whose
    neighbour is in another one, as well. Besides, with ``key``, the number of runs of a
    key that has more than ``many`` in the partition or may go on in another."""
    names = ["doc", "pos", "key", "runs"]

    def kept(held: pa.RecordBatch, before: int | None, after: int | None) -> pa.RecordBatch:
        keys = held.column(0).to_numpy()
        same = keys[1:] == keys[:-1]
        first = before is None or before == keys[0]
        last = after is None or after == keys[-1]
        mask = np.concatenate(([first], same)) | np.concatenate((same, [last]))
        rows = held.filter(pa.array(mask))
        none = pa.nulls(rows.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), none, none], names)

    def counted(keys: np.ndarray, runs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(keys), pa.int64()), pa.nulls(len(keys), pa.int32()), pa.array(keys), pa.array(runs)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, at_start = None, None, True
        open_keys, open_runs = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate((open_keys, batch.column(0).to_numpy()))
            runs = np.concatenate((open_runs, np.ones(batch.num_rows, np.int64)))
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            keys, runs = keys[starts], np.add.reduceat(runs, starts)
            told = runs > many
            told[0] |= at_start
            told[-1] = False
            at_start = at_start and len(keys) == 1
            if told.any():
                yield counted(keys[told], runs[told])
            open_keys, open_runs = keys[-1:], runs[-1:]
            if held is not None:
                yield kept(held, before, batch.column(0)[0].as_py())
                before = held.column(0)[-1].as_py()
            held = batch
        if held is not None:
            yield kept(held, before, None)
            yield counted(open_keys, open_runs)
    return giving_back(run)


def _chooser(alphabet: Alphabet) -> ArrowFunction:
    names = ["key", "span", "doc", "row", "pos", "windows", "place", "before", "behind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows, wanted = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(4)
            flat, at = wanted.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
            pairs = np.sort(at << 32 | flat.astype(np.int64))
            for block in blocks(map(alphabet.hashes, unpacked(batch)), alphabet.length, alphabet.block):
                r = runs_of(block, alphabet.length, alphabet.gram)
                mine = r.owner << 32 | r.pos
                found = np.minimum(np.searchsorted(pairs, mine), max(0, len(pairs) - 1))
                keep = pairs[found] == mine if len(pairs) else np.zeros(len(mine), bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.key[keep].view(np.int64)), pa.array(r.span[keep].view(np.int64)),
                     pa.array(docs[r.owner[keep]]), pa.array(rows[r.owner[keep]]),
                     pa.array(r.pos[keep].astype(np.int32)), pa.array(r.windows[keep].astype(np.int32)),
                     pa.array(r.place[keep].astype(np.int32)),
                     *[pa.array(side[keep].view(np.int64), mask=side[keep] == 0) for side in (r.before, r.behind)]], names)
    return giving_back(run)


def _fetcher(alphabet: Alphabet) -> ArrowFunction:
    names = ["key", "span", "doc", "n", "windows", "place", "piece"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text in enumerate(unpacked(batch)):
                asked = batch.column(4)[at].values
                asked = asked.filter(pc.equal(asked.field("row"), batch.column(2)[at]))
                pos, windows = asked.field("pos").to_numpy(), asked.field("windows").to_numpy()
                places = list(zip(pos.tolist(), (pos + windows - 1 + alphabet.length).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [*[asked.field(c) for c in names[:-1]], pa.array(alphabet.piece(text, places), pa.binary())], names)
    return giving_back(run)


def _divider(alphabet: Alphabet) -> ArrowFunction:
    """Each text in two: its windows that hold fewer symbols before the anchor, and those that hold more."""
    names = ["in_key", "in_span", "doc", "count", "at", "key", "span", "windows", "place", "low", "high", "piece"]
    kinds = [*[pa.int64()] * 4, pa.int32(), *[pa.int64()] * 2, *[pa.int32()] * 4, pa.binary()]

    def digest(*parts: int | bytes) -> int:
        whole = b"".join(p if isinstance(p, bytes) else p.to_bytes(8, "little", signed=True) for p in parts)
        return int.from_bytes(xxh64_digest(whole), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in ("key", "span", "doc", "n", "windows", "place", "low", "high", "piece")]
            rows = []
            for key, span, doc, n, windows, place, low, high, piece in zip(*columns):
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle, high)):
                    # Windows that hold a to b - 1 symbols before the anchor.
                    start, stop = max(0, place - b + 1), min(windows, place - a + 1)
                    if start >= stop:
                        continue
                    shared, part = alphabet.piece(piece, [(place - a, place - b + 1 + alphabet.length),
                                                          (start, stop - 1 + alphabet.length)])
                    rows.append((key, span, doc, n, start, digest(key, a, b, shared),
                                 digest(stop - start, place - start, part), stop - start, place - start, a, b, part))
            values = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)
    return giving_back(run)


def _comparer(compare: Compare) -> ArrowFunction:
    def results(held: pa.Table) -> pa.RecordBatch:
        _, anchor = np.unique(held.column("key").to_numpy(), return_inverse=True)
        windows = held.column("windows").to_numpy().astype(np.int64)
        gone = compare(Spans(anchor, held.column("place").to_numpy().astype(np.int64), windows,
                             held.column("doc").to_numpy(), held.column("n").to_numpy() == 1,
                             held.column("piece").to_pylist()))
        first = np.cumsum(windows) - windows
        span_of = np.repeat(np.arange(len(windows)), windows)
        starts = np.flatnonzero(gone & np.concatenate(([True], ~gone[:-1] | (span_of[1:] != span_of[:-1]))))
        stops = np.flatnonzero(gone & np.concatenate((~gone[1:] | (span_of[1:] != span_of[:-1]), [True])))
        owner = span_of[starts]
        ranges = pa.StructArray.from_arrays(
            [pa.array((starts - first[owner]).astype(np.int32)), pa.array((stops - starts + 1).astype(np.int32))],
            ["start", "windows"])
        offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(windows))))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), ranges)
        return pa.RecordBatch.from_arrays(
            [held.column("key").combine_chunks(), held.column("span").combine_chunks(), lists], ["key", "span", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
            held.append(part)
            size += part.nbytes
            if size > COMPARED_BYTES:
                table = pa.Table.from_batches(held)
                keys = table.column("key").to_numpy()
                # The last anchor may go on in the next part.
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield results(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    size = sum(b.nbytes for b in held)
        if held:
            yield results(pa.Table.from_batches(held))
    return giving_back(run)


def covered(gone: pa.Scalar, row: pa.Scalar, length: int, n: int) -> np.ndarray:
    """Which of a row's ``n`` symbols the windows in ``gone`` cover."""
    edges = np.zeros(n + 1, np.int64)
    if gone.is_valid:
        mine = gone.values.filter(pc.equal(gone.values.field("row"), row)).field("ranges").flatten()
        starts, windows = (mine.field(c).to_numpy().astype(np.int64) for c in ("start", "windows"))
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + windows - 1 + length, -1)
    return np.cumsum(edges[:-1]) > 0
