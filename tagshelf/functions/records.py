"""What a task does with the lines of a byte range of delimited text whose fields may hold line breaks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks get these functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ArrowFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# Bytes of lines looked at, and characters of records handed on, at a time: what a task holds
# beside the Arrow batch it was given, whatever the number of lines in that.
PIECE_BYTES = 1024 * 1024


class UnclosedQuoteError(ValueError):
    """A quoted field goes on for longer than a record may be."""


@dataclass(frozen=True)
class Quoting:
    """How fields are separated and quoted; a field is quoted if a quote is the first thing in it."""

    sep: str
    quote: str
    escape: str

    def ends_inside(self, line: str, inside: bool) -> bool:
        """Whether the end of a line lies in a quoted field, given whether its start does."""
        place = 0
        while True:
            if not inside:
                if not line.startswith(self.quote, place):
                    place = line.find(self.sep, place)
                    if place < 0:
                        return False
                    place += len(self.sep)
                    continue
                place += 1
            place = self._closing(line, place)
            if place < 0:
                return True
            inside = False
            # What follows a closing quote up to the separator belongs to the field, quotes or not.
            place = line.find(self.sep, place + 1)
            if place < 0:
                return False
            place += len(self.sep)

    def _closing(self, line: str, start: int) -> int:
        place = line.find(self.quote, start)
        while place >= 0:
            if self.escape == self.quote:
                if not line.startswith(self.quote, place + 1):
                    return place
                place = line.find(self.quote, place + 2)
            else:
                before = place
                while before > start and line[before - 1] == self.escape:
                    before -= 1
                if (place - before) % 2 == 0:
                    return place
                place = line.find(self.quote, place + 1)
        return -1


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches (value, file, start, ...) cut where a range begins."""
    for batch in batches:
        if batch.num_rows:
            file, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                yield from _pieces(batch.slice(a, b - a))


def _pieces(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in turn, as many at a time as hold ``PIECE_BYTES`` of lines, or one that is longer."""
    behind = np.cumsum(pc.binary_length(rows.column(0)).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < rows.num_rows:
        before = behind[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(behind, before + PIECE_BYTES, "right")))
        yield rows.slice(a, b - a)
        a = b


def _key(rows: pa.RecordBatch) -> tuple[int, int]:
    return rows.column(1)[0].as_py(), rows.column(2)[0].as_py()


def range_states(quoting: Quoting) -> ArrowFunction:
    """What a range does to the state: where its end lies, if its start lies outside and inside of a
    quoted field, and whether a record ends in it in the latter case."""

    def run(batches):
        key, outside, inside, closed = None, False, True, False
        found = []
        for rows in _ranges(batches):
            if _key(rows) != key:
                if key is not None:
                    found.append((*key, outside, inside, closed))
                key, outside, inside, closed = _key(rows), False, True, False
            lines = rows.column(0)
            quoted = pc.match_substring(lines, quoting.quote)
            closed |= not inside
            for line in lines.filter(quoted).to_pylist():
                same = outside == inside
                outside = quoting.ends_inside(line, outside)
                inside = outside if same else quoting.ends_inside(line, inside)
                closed |= not inside
        if key is not None:
            found.append((*key, outside, inside, closed))
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)],
                                         ["file", "start", "from_outside", "from_inside", "closed"])

    return run


def range_records(quoting: Quoting, header: bool, most: int) -> ArrowFunction:
    """The records of ranges of lines (value, file, start, inside, owner), of text or in fragments.

    ``inside`` tells that a range starts within a record, which began in the range ``owner``.
    Rows are (record, file, owner, place, first): a record that lies in one range has no
    ``owner``; fragments of others have that of the range where the record begins, and the
    ``place`` of their own. The first record of a file is left out if it is the ``header``, or
    marked as ``first`` where it is a fragment.
    """

    def run(batches):
        out = _Records()
        state = None
        for rows in _ranges(batches):
            key = _key(rows)
            if state is None or state.key != key:
                if state is not None:
                    state.close(out)
                state = _Range(key, bool(rows.column(3)[0].as_py()), rows.column(4)[0].as_py(), header, most)
            lines = rows.column(0)
            if state.pending is None and not state.first and not _any(pc.match_substring(lines, quoting.quote)):
                if len(out):
                    yield out.batch()
                yield _whole(lines)
                continue
            for line in lines.to_pylist():
                state.add(line, quoting, out)
            if out.chars >= PIECE_BYTES:
                yield out.batch()
        if state is not None:
            state.close(out)
        yield out.batch()

    return run


def _any(flags: pa.Array) -> bool:
    return bool(pc.any(flags).as_py())


class _Records:
    """Rows to be handed on."""

    KINDS = (("record", pa.string()), ("file", pa.int64()), ("owner", pa.int64()), ("place", pa.int64()),
             ("first", pa.bool_()))

    def __init__(self):
        self.rows: list[tuple] = []
        self.chars = 0

    def __len__(self) -> int:
        return len(self.rows)

    def add(self, record: str, *place: object) -> None:
        self.rows.append((record, *place) if place else (record, None, None, None, None))
        self.chars += len(record) + 1

    def batch(self) -> pa.RecordBatch:
        rows, self.rows, self.chars = self.rows, [], 0
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(self.KINDS)],
                                          [name for name, _ in self.KINDS])


def _whole(lines: pa.Array) -> pa.RecordBatch:
    empty = [pa.nulls(len(lines), kind) for _, kind in _Records.KINDS[1:]]
    return pa.RecordBatch.from_arrays([lines, *empty], [name for name, _ in _Records.KINDS])


class _Range:
    """A range while its lines pass by; ``pending`` has the lines of the record that is open."""

    def __init__(self, key: tuple[int, int], inside: bool, owner: int | None, header: bool, most: int):
        self.key, self.most = key, most
        self.pending: list[str] | None = [] if inside else None
        self.size = 0
        self.owner = owner if inside else key[1]
        self.first = header and key[1] == 0

    def add(self, line: str, quoting: Quoting, out: _Records) -> None:
        inside = self.pending is not None
        if quoting.quote in line:
            still = quoting.ends_inside(line, inside)
        else:
            still = inside
        if not inside and not still:
            if self.first:
                self.first = not line.strip()      # blank lines before it are no header
            else:
                out.add(line)
            return
        self.pending = self.pending or []
        self.pending.append(line)
        self.size += len(line) + 1
        if self.size > self.most:
            raise UnclosedQuoteError(
                f"a quoted field before or after byte {self.key[1]} of a file goes on for more than {self.most}"
                " characters: is a quote missing? Read text that doesn't quote with quote=''")
        if not still:
            self._end(out, self.owner != self.key[1])

    def _end(self, out: _Records, fragment: bool) -> None:
        record = "\n".join(self.pending)
        if fragment:
            out.add(record, self.key[0], self.owner, self.key[1], self.first)
            self.first = False
        elif self.first:
            self.first = False
        else:
            out.add(record)
        self.pending, self.size, self.owner = None, 0, self.key[1]

    def close(self, out: _Records) -> None:
        if self.pending is not None:
            self._end(out, True)
