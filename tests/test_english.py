from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest

from tagshelf.operators import english

NAMES = "code main_category categories_tags"
# Everything by broadcast; and by shuffle, with every key taken for a frequent one.
PATHS = [{}, {"broadcast_bytes": -1}, {"broadcast_bytes": -1, "hot_rows": 1}]


def plain(data):
    """What is kept, said in Python."""
    def bad(tags):
        return tags is not None and any(not t.strip(" ").startswith("en:") for t in tags.split(","))
    codes = {c for c, m, t in data if bad(m) or bad(t)}
    return sorted((r for r in data if r[0] is None or r[0] not in codes), key=repr)


def run(rows, data, **options):
    df = rows(NAMES, data).repartition(3)
    return sorted((tuple(r) for r in english.english_only(df, **options).collect()), key=repr)


EDGES = [
    (None, "fr:x", "en:a"), ("1", "en:a", "en:b"), ("1", "en:a", "fr:b"), ("2", "en:a", None),
    ("3", None, None), ("4", "en:a", ""), ("5", "en:a", " en:a,  en:b"), ("6", "en:a", "en:a,"),
    ("7", "EN:a", "en:a"), ("8", "en:a", "en:a"), ("8", "en:a", "en:a"), ("9", "en:a,xen:b", "en:a"),
    ("10", "\ten:a", "en:a"), ("11", "en:a\nfr:b", "en:a"),
]


@pytest.mark.parametrize("options", PATHS)
def test_edges(shuffled_joins, rows, options):
    assert run(rows, EDGES, **options) == plain(EDGES)


@pytest.mark.parametrize("options", PATHS)
def test_a_third_of_all_rows_under_one_code(shuffled_joins, rows, options):
    data = [("hot", "en:a", "en:b")] * 300 + [(None, "en:a", "fr:b")] * 300 \
        + [(str(i), "en:a", "fr:b" if i % 3 else "en:b") for i in range(300)]
    assert run(rows, data, **options) == plain(data)
    mixed = data + [("hot", "en:a", "de:b")]
    assert run(rows, mixed, **options) == plain(mixed)


tag = st.sampled_from(["en:a", " en:b", "fr:c", "", "en:", "e", " "])
tags = st.none() | st.lists(tag, min_size=1, max_size=3).map(",".join)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, *"abcdefgh"]), tags, tags), min_size=1, max_size=40))
def test_any_rows(shuffled_joins, rows, data):
    for options in PATHS[::2]:
        assert run(rows, data, **options) == plain(data)


def test_codes_and_left_over_tags(rows):
    df = rows(NAMES, EDGES)
    codes = sorted((r.code for r in english.non_english_codes(df).collect()), key=repr)
    assert codes == sorted([None, "1", "4", "6", "7", "9", "10"], key=repr)
    assert english.non_english_tags(english.english_only(df.filter("code is not null"))).count() == 0
    assert english.non_english_tags(df).count() == 3
