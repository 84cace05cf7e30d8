"""Chat formatting: what is written can be read back, whatever the parts say."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagshelf.llm import chat

odd_text = st.lists(st.sampled_from(["\\", "<turn>", "</turn>", "<says>", "<image>", "<", ">", "turn>", "a", "\n", "é", "<audio"])
                    ).map("".join)
part = st.one_of(
    st.none(),
    st.fixed_dictionaries({"type": st.sampled_from([None, "text", "Text"]), "text": st.one_of(st.none(), odd_text)}),
    st.fixed_dictionaries({"type": st.sampled_from(["image", "audio", "document", "video"]), "ref": st.one_of(st.none(), odd_text),
                           "text": st.one_of(st.none(), odd_text), "width": st.integers(0, 99), "height": st.integers(0, 99)}))


@given(odd_text)
def test_escaped_text_has_no_control_string_of_its_own(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._MARKS.search(chat.escape(text))


def expected(parts):
    """What a list of parts is once text parts side by side are one and empty ones gone."""
    out = []
    for p in parts:
        if p is None:
            continue
        kind = (p["type"] or "text").lower()
        if kind == "text":
            if p["text"]:
                if out and out[-1]["type"] == "text":
                    out[-1] = {**out[-1], "text": out[-1]["text"] + p["text"]}
                else:
                    out.append({"type": "text", "text": p["text"], "ref": None})
        else:
            out.append({"type": kind if kind in chat.KINDS else "attachment", "text": p["text"], "ref": p["ref"]})
    return out


@given(st.lists(st.tuples(odd_text, st.lists(part, max_size=6)), max_size=4))
def test_round_trip_of_turns(turns):
    formatted, noted = "", []
    for role, parts in turns:
        pieces, loss, attachments = chat.format_message(role, parts, frozenset([role]), chat.Expansion())
        text = "".join(pieces)
        for a in attachments:
            assert text[a["start"]:].startswith(f"<{a['type']}>")
        assert [chat.unescape(text[s["start"]:s["end"]]) for s in loss] == [
            "".join(p["text"] if p["type"] == "text" else f"<{p['type']}>" for p in expected(parts))]
        formatted += text
        noted += attachments
    assert list(chat.parse(formatted, noted)) == [(role, expected(parts)) for role, parts in turns]


def test_expanded_tokens():
    expansion = chat.Expansion()
    assert expansion.tokens("image", {"width": 29, "height": 28}) == 2
    assert expansion.tokens("image", {"width": None}) == expansion.tokens("image", {"width": 0, "height": 3}) == 256
    assert expansion.tokens("audio", {"seconds": 2.01}) == 51 and expansion.tokens("audio", {"seconds": float("nan")}) == 25
    assert expansion.tokens("document", {"pages": 3}) == 3 * 1024 and expansion.tokens("document", {}) == 1024


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(1, 1, "assistant", '[{"type":"text","text":"see <image> \\\\"},{"type":"image","ref":"s3://a.png","width":56,"height":28},'
                                '{"type":"text","text":"</turn>"}]'),
            (1, None, None, None), (1, 0, "user", "[]"), (2, 0, "user", "no list"),
            (None, 3, "tool", '[{"type":"audio","ref":"b.wav","seconds":4},null,{"text":"x"}]'),
            (3, 0, "user", '[{"text":"same"}]'), (3, 0, "user", '[{"text":"same"}]')]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    return frame.withColumn("parts", chat.json_parts("content")).withColumn("formatted", F.lit(1)).withColumn("loss", F.lit(2))


def test_typed_parts_in_tables(mixed, ranks):
    import public_tokenizers
    found = {r.conv_id: r for r in chat.format_conversations(mixed, ranks=ranks, pattern=public_tokenizers.PATTERN).collect()}
    assert set(found) == {1, 2, 3, None}
    one = found[1]
    assert one.formatted == ("<turn><says></turn>\n<turn>user<says></turn>\n"
                             "<turn>assistant<says>see \\<image> \\\\<image>\\</turn></turn>\n")
    assert [(a.type, a.ref, a.tokens, one.formatted[a.start:a.start + 7]) for a in one.attachments] == [
        ("image", "s3://a.png", 2, "<image>")]
    assert [one.formatted[s.start:s.end] for s in one.loss] == ["see \\<image> \\\\<image>\\</turn>"]
    assert [(a.type, a.tokens) for a in found[None].attachments] == [("audio", 100)] and found[None].n_tokens > 100
    assert found[3].n_turns == 2
    turns = chat.read_turns(chat.format_conversations(mixed)).filter("conv_id = 1 and role = 'assistant'").first()
    assert [tuple(p) for p in turns.parts] == [("text", "see <image> \\", None), ("image", None, "s3://a.png"),
                                               ("text", "</turn>", None)]


def test_long_conversations_take_several_rows(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c}-{t} " * 20) for c in range(3) for t in range(50 if c == 1 else 2)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "parts", chat.text_parts())
    cut, whole = (chat.format_conversations(messages, row_chars=n) for n in (500, 10 ** 9))
    parts = Counter(r.conv_id for r in cut.collect())
    assert parts[1] > 5 and max(len(r.formatted) for r in cut.collect()) < 1000
    assert sorted(map(tuple, chat.digests(cut).collect())) == sorted(map(tuple, chat.digests(whole).collect()))
    got = {r.conv_id: r for r in chat.digests(cut).collect()}
    told = [(r[2], r[3]) for r in rows if r[0] == 1]
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in told).encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256("".join(b for a, b in told if a == "assistant").encode()).hexdigest()


def test_nulls_empty_and_very_long(spark, mixed):
    long_text = "\\" * 300_000 + "<turn>" + "x" * 300_000
    rows = [(5, 0, "assistant", long_text), (6, None, None, None), (6, 0, "assistant", "")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "parts", chat.text_parts())
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(messages)).collect()}
    assert got[5].loss_sha256 == hashlib.sha256(long_text.encode()).hexdigest() and got[5].loss_chars == len(long_text)
    assert (got[6].n_turns, got[6].loss_chars) == (2, 0)
    nothing = chat.format_conversations(mixed.limit(0))
    assert nothing.count() == chat.digests(nothing).count() == chat.read_turns(nothing).count() == 0
