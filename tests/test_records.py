"""Text with line breaks in fields, read by many tasks: the same rows as Spark's reader of whole files."""

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagshelf import sources
from tagshelf.functions.records import Quoting, UnclosedQuoteError, range_records, range_states


@pytest.fixture
def small_ranges(spark):
    """Files are divided into very small byte ranges."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def divide(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield divide
    for k, v in old.items():
        spark.conf.set(k, v)


def field(draw, sep, escape, newline):
    """One field as it is written; quotes inside of unquoted ones are text."""
    pieces = ["a", "bé", " ", "1", "\\" if escape == '"' else "/"]
    if draw.random() < 0.5:
        # Behind a separator of two characters Spark parses a quote at a record's end in two ways.
        stray = ["", '5"x', '5" "'] if len(sep) == 1 else ["", '5"x']
        return "".join(draw.choice([*pieces, "'"]) for _ in range(draw.randrange(4))) + draw.choice(stray) * (draw.random() < .3)
    inner = [*pieces, sep, newline, newline * 2, escape + '"', "long " * draw.randrange(20)]
    return '"' + "".join(draw.choice(inner) for _ in range(draw.randrange(3))) + '"'


def written(seed, sep, escape, newline):
    draw = random.Random(seed)
    rows = [sep.join(["a", '"b"', "c"])]
    for i in range(draw.randrange(1, 60)):
        rows.append(sep.join([str(i), *[field(draw, sep, escape, newline) for _ in range(draw.choice([2, 2, 2, 1]))]]))
        rows += [""] * (draw.random() < 0.1)
    return newline.join(rows) + newline * (newline != "\n" or draw.randrange(2))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("sep, escape, newline", [(",", '"', "\n"), ("\t", "\\", "\n"), (";;", '"', "\r\n")])
def test_equal_to_sparks_reader_of_whole_files(spark, tmp_path, small_ranges, seed, sep, escape, newline):
    for i in range(2):
        (tmp_path / f"{i}.csv").write_bytes(written(100 * seed + i, sep, escape, newline).encode())
    whole = spark.read.csv(str(tmp_path), header=True, sep=sep, quote='"', escape=escape, multiLine=True)
    want = Counter(map(tuple, whole.collect()))
    small_ranges(random.Random(seed).choice([7, 40, 300]))
    got = sources.read_delimited(spark, str(tmp_path), sep, escape=escape, multi_line=True)
    assert got.columns == whole.columns
    assert Counter(map(tuple, got.collect())) == want


def test_one_file_is_read_by_many_tasks(spark, rows, tmp_path, small_ranges):
    data = [(str(i), "line\nbreak " * (i % 7), 'quo"te') for i in range(3000)]
    sources.write_delimited(rows("a b c", data).coalesce(1), str(tmp_path / "out"))
    small_ranges(8_000)
    back = sources.read_delimited(spark, str(tmp_path / "out"), ",", multi_line=True)
    assert back.rdd.getNumPartitions() > 10
    assert Counter(map(tuple, back.collect())) == Counter((a, b or None, c) for a, b, c in data)


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    text = 'k,v\n1,"' + "x\n" * 500 + '"\n2,"y\nz"\n3,w\n'
    (tmp_path / "t.csv").write_text(text)
    small_ranges(50)
    got = sources.read_delimited(spark, str(tmp_path), ",", multi_line=True)
    assert sorted(map(tuple, got.collect())) == [("1", "x\n" * 500), ("2", "y\nz"), ("3", "w")]


def test_a_header_over_two_ranges_and_empty_files(spark, tmp_path, small_ranges):
    (tmp_path / "t.csv").write_text('"first\nname",v\n1,2\n')
    (tmp_path / "u.csv").write_text('"first\nname",v\n')
    (tmp_path / "v.csv").write_text("")
    small_ranges(4)
    got = sources.read_delimited(spark, str(tmp_path), ",", multi_line=True, columns=["a", "b"])
    assert list(map(tuple, got.collect())) == [("1", "2")]
    assert sources.read_records(spark, str(tmp_path), ",", header=False).count() == 3


def test_a_quote_that_is_not_closed(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x\n' + "2,y\n" * 50)
    short = sources.read_delimited(spark, str(tmp_path), ",", multi_line=True)
    assert short.count() == 1
    with pytest.raises(Exception, match=UnclosedQuoteError.__name__):
        sources.read_records(spark, str(tmp_path), ",", record_chars=100).count()


@pytest.mark.parametrize("last", ['y"', "y"])
def test_a_task_looks_at_a_part_of_a_batch_at_a_time(last):
    """What a task holds beside the batch it was given does not grow with that: 16 MB of lines here."""
    lines = pa.array(["h"] + ['1,"' + "x" * 4_000, last.rjust(4_000)] * 2_000 + ['"'])
    kinds = {"file": pa.int64(), "start": pa.int64(), "inside": pa.bool_(), "owner": pa.int64()}
    values = (0, 0, False, None)
    batch = pa.RecordBatch.from_arrays([lines, *[pa.array([v] * len(lines), k) for v, k in zip(values, kinds.values())]],
                                       ["value", *kinds])
    quoting, text = Quoting(",", '"', '"'), "\n".join(lines.to_pylist()[1:])
    tracemalloc.start()
    try:
        list(range_states(quoting)(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 6e6
        if last == 'y"':
            read, most = 0, 0
            for out in range_records(quoting, True, 64 << 20)(iter([batch])):
                read, most = read + out.num_rows, max(most, out.nbytes)
            assert tracemalloc.get_traced_memory()[1] < 8e6
            assert read == 2_001 and most < 4e6
    finally:
        tracemalloc.stop()
    if last == "y":      # one quoted field over all lines: whole, as long as it may be
        whole = [r for out in range_records(quoting, True, 64 << 20)(iter([batch])) for r in out.column(0).to_pylist()]
        assert "\n".join(whole) == text


@settings(max_examples=300)
@given(st.text(alphabet='",ab \n', max_size=40), st.booleans())
def test_the_state_after_a_line_is_that_of_its_parts(text, inside):
    """A quote state carried over line breaks is that of the text as a whole, character by character."""
    quoting, state = Quoting(",", '"', '"'), inside
    for line in text.split("\n"):
        state = quoting.ends_inside(line, state)
    assert state == by_character(text, inside)


def by_character(text, inside):
    at = "quoted" if inside else "start"
    i = 0
    while i < len(text):
        c = text[i]
        if at == "quoted":
            if c == '"':
                if text[i + 1:i + 2] == '"':
                    i += 1
                else:
                    at = "rest"
        elif c in ",\n":
            at = "start"
        elif at == "start":
            at = "quoted" if c == '"' else "rest"
        i += 1
    return at == "quoted"
