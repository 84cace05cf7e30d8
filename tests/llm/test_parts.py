"""Parts of the operators by themselves."""

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagshelf.llm import (anchors, bpe, decontaminate, quality, simhash, substring_dedup, suffix_dedup, toxicity,
                          url_filter)

few_letters = st.lists(st.integers(1, 3), min_size=1, max_size=80)


@given(few_letters)
@settings(deadline=None, max_examples=200)
def test_suffixes_are_sorted(text):
    ranks = suffix_dedup.suffix_ranks(np.array(text))
    assert np.argsort(ranks).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
@settings(deadline=None, max_examples=200)
def test_runs_hold_every_window_once_and_equal_windows_meet(texts):
    length, gram = 7, 3
    symbols = [anchors.mixed(np.array(t, np.uint64) + np.uint64(9)) for t in texts]
    seen, anchor_of = set(), {}
    for block in anchors.blocks(iter(symbols), length):
        r = anchors.runs_of(block, length, gram)
        for owner, pos, windows, place, key in zip(r.owner, r.pos, r.windows, r.place, r.key):
            for i in range(windows):
                seen.add((owner, pos + i))
                window = tuple(texts[owner][pos + i:pos + i + length])
                assert anchor_of.setdefault(window, (key, place - i)) == (key, place - i)
    assert seen == {(o, i) for o, t in enumerate(texts) for i in range(len(t) - length + 1)}


def test_long_documents_are_cut_in_overlapping_pieces(monkeypatch):
    monkeypatch.setattr(anchors, "PIECE", 20)
    symbols = anchors.mixed(np.arange(100, dtype=np.uint64) % np.uint64(7))
    found = set()
    for block in anchors.blocks(iter([symbols]), 7):
        r = anchors.runs_of(block, 7, 3)
        found |= {p + i for p, w in zip(r.pos, r.windows) for i in range(w)}
    assert found == set(range(94))


WORDS = st.lists(st.sampled_from(["a", "b", "c"]), max_size=40).map(" ".join)


@given(st.lists(WORDS, min_size=2, max_size=5))
@settings(deadline=None, max_examples=100)
def test_trees_and_arrays_against_brute_force(texts):
    """The comparisons alone, with every window of a text in one span."""
    window = 4
    rows = [(d, t) for d, t in enumerate(texts) if len(t.split()) >= window]
    if not rows:
        return
    split = [t.split() for _, t in rows]
    counts = np.array([len(s) - window + 1 for s in split])
    # A run has one anchor; here each window is made its own run with the same anchor and place.
    pieces = [" ".join(s[i:i + window]).encode() for s, n in zip(split, counts) for i in range(n)]
    owners = np.repeat([d for d, _ in rows], counts)
    ones = np.ones(len(pieces), np.int64)
    spans = anchors.Spans(0 * ones, 0 * ones, ones, owners, ones == 1, pieces)
    gone = substring_dedup.shared_windows(spans, window)
    first = {}
    for p, o in zip(pieces, owners):
        first[p] = min(first.get(p, o), o)
    assert gone.tolist() == [bool(first[p] < o) for p, o in zip(pieces, owners)]
    size = min(map(len, pieces))
    same = suffix_dedup.repeated_starts(spans, size) if size >= 8 else None
    if same is not None:
        heads = [p[:size] for p in pieces]
        assert same.tolist() == [heads.count(h) > 1 for h in heads]


@given(st.text(alphabet="ab c'1\n\u00e9.,\u3000", max_size=200))
@settings(deadline=None, max_examples=200)
def test_pieces_are_encoded_as_the_whole(text):
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        encoding = _codec(file.read())
    whole = encoding.encode_ordinary(text)
    assert [i for p in bpe.pieces(text, 5) for i in encoding.encode_ordinary(p)] == whole
    assert "".join(bpe.pieces(text, 5)) == text


_known = []


def _codec(content):
    if not _known:
        import public_tokenizers
        _known.append(bpe.codec(content, public_tokenizers.PATTERN))
    return _known[0]


def _few(compare, most):
    """``compare``, which refuses more spans of an anchor than ``most``."""
    def run(spans):
        if np.bincount(spans.anchor).max() > most:
            raise ValueError("too many spans of one anchor")
        return compare(spans)
    return run


def test_an_anchor_of_very_many_spans_is_divided(spark, monkeypatch):
    """A short passage in many surroundings, a long one, and copies of a few of them."""
    monkeypatch.setattr(anchors, "GROUP_SPANS", 12, raising=False)
    grown, ordered = substring_dedup._grown, suffix_dedup._sorted
    monkeypatch.setattr(substring_dedup, "_grown", lambda window: _few(grown(window), 12))
    monkeypatch.setattr(suffix_dedup, "_sorted", lambda length: _few(ordered(length), 12))
    rng = random.Random(1)

    def noise(n):
        return " ".join(f"{rng.getrandbits(24):x}" for _ in range(n))

    short, long = noise(9), noise(30)
    rows = {i: f"{noise(20)} {short} {noise(20)}" for i in range(60)}
    rows |= {100 + i: f"{noise(6)} {long} {noise(6)}" for i in range(60)}
    left, right = [noise(5) for _ in range(4)], [noise(5) for _ in range(4)]
    rows |= {200 + i: f"{noise(8)} {left[i % 4]} {short} {right[i // 4 % 4]} {noise(8)}" for i in range(48)}
    rows |= {300 + i: rows[5 * i] for i in range(6)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_removed, brute.sha(bytes(r.kept)))
             for r in substring_dedup.drop_repeated_words(docs).collect()}
    assert found == brute.substrings(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), brute.sha(bytes(r.kept)))
           for r in suffix_dedup.drop_repeated_bytes(docs, length=90).collect()}
    assert got == brute.suffixes(rows, 90)


PASSAGE = st.lists(st.sampled_from("abcde"), max_size=30)


@given(PASSAGE, st.lists(st.sampled_from("abcde"), min_size=1, max_size=15))
@settings(deadline=None, max_examples=200)
def test_alignment(passage, item):
    score, start, end = decontaminate.align(passage, item)
    assert score == brute.alignment(passage, item)
    assert score == 0 or brute.alignment(passage[start:end], item) == score


@given(st.lists(st.sampled_from("abcdefghijkl"), max_size=60), st.lists(st.sampled_from("abcde"), min_size=1, max_size=8),
       st.sampled_from([0.2, 0.5, 0.8, 1.0]))
@settings(deadline=None, max_examples=300)
def test_only_passages_below_the_threshold_are_not_aligned(passage, item, threshold):
    whole, parts = decontaminate.align(passage, item), decontaminate.align_parts(passage, item, threshold)
    if whole[0] >= threshold * decontaminate.MATCH * len(item):
        assert parts == whole
    else:
        assert parts[0] <= whole[0]


def _edits(words, kind, share, rng):
    if kind == "random":
        return [f"new{rng.random()}" if rng.random() < share else w for w in words]
    step = max(2, round(1 / share))
    if kind == "periodic":
        return [f"new{i}" if i % step == step - 1 else w for i, w in enumerate(words)]
    if kind == "insertion":
        return [x for i, w in enumerate(words) for x in ([w, f"new{i}"] if i % step == step - 1 else [w])]
    return [w for i, w in enumerate(words) if i % step != step - 1]


@pytest.mark.parametrize("kind", ["random", "periodic", "insertion", "deletion"])
def test_all_edited_copies_that_reach_the_threshold_are_found(spark, sf, kind):
    """Recall is 1 whatever the edit: what the filters let through is compared with all pairs."""
    rng = random.Random(kind)
    items = {r.item_id: decontaminate.words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    noise = [w for item in items.values() for w in item]
    docs, want = {}, set()
    for share in (0.1, 0.2, 0.34, 0.5):
        for i, words in items.items():
            around = [" ".join(rng.choices(noise, k=rng.randrange(40))) for _ in range(2)]
            docs[len(docs)] = f"{around[0]} {' '.join(_edits(words, kind, share, rng))} {around[1]}"
    for d, text in docs.items():
        want |= {(d, i) for i, item in items.items() if brute.leaked(decontaminate.words_of(text), item) >= decontaminate.THRESHOLD}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = decontaminate.leaks(table, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert len({d for d, _ in want}) >= 0.4 * len(docs)


@given(PASSAGE, st.lists(st.sampled_from("abcde"), min_size=1, max_size=15))
@settings(deadline=None, max_examples=200)
def test_the_longest_common_subsequence(passage, item):
    best = [0] * (len(item) + 1)
    for w in passage:
        best = [0] + [max(best[j + 1], best[j] + 1 if w == v else 0) for j, v in enumerate(item)]
        for j in range(len(item)):
            best[j + 1] = max(best[j + 1], best[j])
    assert decontaminate.matched_in_order(passage, decontaminate.places_of(item), len(item)) == best[-1]


@pytest.mark.parametrize("block", [1, 60])
def test_items_in_several_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "ITEM_CHARS", block)
    texts = {i: " ".join(f"w{i}x{k}" for k in range(20)) for i in range(6)}
    table = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    docs = spark.createDataFrame([(i, f"a b {t} c") for i, t in texts.items()], "doc_id long, text string")
    found = decontaminate.leaks(docs, table).collect()
    assert {(r.doc_id, r.item_id, r.score, r.start, r.end) for r in found} == {(i, i, 1.0, 2, 22) for i in texts}


@pytest.mark.parametrize("copies", [1, 2, 40])
def test_edited_passages_are_found_however_many_documents_have_them(spark, copies):
    words = [f"w{i}" for i in range(40)]
    edited = [f"new{i}" if i % 5 == 4 else w for i, w in enumerate(words)]
    docs = [(i, " ".join([f"a{i}", *edited, f"b{i}"])) for i in range(copies)]
    docs += [(1000, " ".join(["before", *words[:20], "after"]))]
    docs += [(2000 + i, f"other text number {i} of no item") for i in range(300)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {r.doc_id for r in found} == {*range(copies), 1000}


@pytest.mark.parametrize("seed", range(3))
def test_links_connect_what_is_near(spark, monkeypatch, seed):
    """Chains and clouds of fingerprints over many shards and blocks."""
    monkeypatch.setattr(simhash, "SHARD_SIZE", 30)
    rng = random.Random(seed)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for x in list(prints)[:20]:
        for _ in range(8):
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = sorted(x - 2 ** 64 if x >= 2 ** 63 else x for x in prints)
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r.node: r.root for r in simhash.connect(simhash.links(table, 4)).collect()}
    want = brute.components(signed, lambda a, b: ((a ^ b) % 2 ** 64).bit_count() <= 4)
    assert {x: found.get(x, x) for x in signed} == want


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200 - i, 199 - i) for i in range(40)] + [(7, 7)]
    found = {r.node: r.root for r in simhash.connect(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n for n, r in found.items() if r == 0} == set(range(1, 61))
    assert {n for n, r in found.items() if r == 160} == set(range(161, 201))


def kinds(text, lexicon=None):
    lexicon = lexicon or {"idiot": 2.0, "fool*": 1.0}
    got = toxicity.matched(text, lexicon, {}, toxicity.grammar())
    return {k for k, v in zip(toxicity.KINDS, got) if v}


def test_grammar():
    assert kinds("What an idiot.") == {"insult"}
    assert kinds("You are an idiot.") == {"aimed_insult"}
    assert kinds("This is not an idiot") == {"negated_insult"}
    assert kinds("It does not matter. What an idiot") == {"insult"}
    assert kinds("She said somebody in the room was an idiot") == {"reported_insult"}
    assert kinds("I will kill you; foolishness") == {"threat", "insult"}
    assert kinds("you, them, kill") == {"aimed_threat"}
    assert kinds("nothing here") == set()


def test_url_base_parts(spark):
    table = spark.createDataFrame([("HTTP://A.B/C?d",)], "url string")
    assert tuple(url_filter.with_host_and_path(table).first()) == ("HTTP://A.B/C?d", "a.b", "/C")


def test_script_is_told_by_all_letters():
    # Every fourth character, the stride of a sample of 4,096, is Latin.
    assert quality.main_script("a\u0436\u0436\u0436" * 4096) == "Cyrillic"
    assert quality.main_script(("." * 3 + "\u0436") * 4096) == "Cyrillic"


def test_what_a_vocabulary_spells_in_bytes(pieces):
    import public_tokenizers
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    known = frozenset(pieces.value).union(" \t\n\x0b\x0c\r")
    rng = random.Random(5)
    pool = "abcXYZ09éüßяж漢字仮名ひらがなहिन्दी한글עבריתعربي😀𝔘\u200d€–„“"
    for _ in range(300):
        word = "".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))
        spelt = sum(map(model.is_byte, model.encode(word)))
        assert quality.fallback_share(word, known) == spelt / len(word.encode()), word
    assert quality.fallback_share(" \n", known) == 0 and quality.fallback_share("", known) == 0



def test_short_texts_are_judged_by_the_vocabulary():
    band = quality.BANDS["Latin"]
    assert not quality.fits(band, 40, (1.2, 0.0, 5.0))
    assert not quality.fits(band, 40, (4.0, 0.5, 5.0))
    assert not quality.fits(band, 40, (4.0, 0.0, 1.0))
    # Twelve different tokens have 3.58 bits; eight, 3 bits, less than a long text needs.
    assert quality.fits(band, 12, (4.0, 0.0, 3.58)) and quality.fits(band, 8, (4.0, 0.0, 3.0))
