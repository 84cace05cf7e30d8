"""Quality rules: how well public vocabularies fit a text, and plain rules before that.

Tokens of a byte-level vocabulary are counted per text: characters per token, and the entropy
of the tokens. A vocabulary of pieces with byte fallback tells how much of a text it has to
spell in bytes. A band per script, or per language where given, tells which values are rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import codec, encode_text
from .common import WHITE_SPACE, ArrowFunction, by_value, text_or_empty, texts_of

by_value(__name__)

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20
# Texts with fewer tokens cannot have the entropy of longer ones: the bound shrinks with
# the logarithm of their number.
MIN_TOKENS = 50


class Band(NamedTuple):
    """Values outside are rejected. Entropy is in bits per token; what falls back is a share of the bytes."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_fallback: float
    min_entropy: float


# By script of most letters; "" is for texts without letters. A script's band is wide
# enough for ordinary prose in any of its languages.
BANDS: Mapping[str, Band] = {
    "Latin": Band(1.9, 8.0, 0.25, 3.5),
    "Cyrillic": Band(1.0, 8.0, 0.35, 3.0),
    "Greek": Band(0.8, 8.0, 0.6, 3.0),
    "Arabic": Band(0.8, 8.0, 0.6, 3.0),
    "Hebrew": Band(0.6, 8.0, 0.7, 3.0),
    "Devanagari": Band(0.5, 8.0, 0.8, 3.0),
    "Han": Band(0.4, 4.0, 0.9, 3.0),
    "Hiragana": Band(0.4, 4.0, 0.9, 3.0),
    "Hangul": Band(0.4, 4.0, 0.9, 3.0),
    "other": Band(0.3, 10.0, 1.0, 2.5),
    "": Band(0.0, float("inf"), 1.0, 0.0),
}
_SCRIPTS = tuple(s for s in BANDS if s not in ("", "other"))

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")
_RATES = ("chars_per_token", "fallback_share", "token_entropy")


def read_pieces(spark: SparkSession, path: str) -> Broadcast:
    """The characters that a vocabulary of pieces has, from its file, sent to all executors.

    A character that is no piece is spelt by the tokens of its bytes, whatever stands around it:
    pieces grow from characters, and none grows from what is not there.
    """
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    one = {p for i in range(pieces.get_piece_size())
           if len(p := pieces.id_to_piece(i)) == 1 and not (pieces.is_byte(i) or pieces.is_control(i))}
    return spark.sparkContext.broadcast("".join(sorted(one)))


def quality(docs: DataFrame, ranks: Broadcast, pattern: str, pieces: Broadcast, bands: Mapping[str, Band] = BANDS,
            language: str | None = None) -> DataFrame:
    """One row per row of (doc_id, text): the counts, the rates, ``script``, ``base_failed``, ``kept``.

    ``base_failed``: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEATED_PERCENT``
    percent of the words in repeated windows. ``kept``: not that, and inside the band. With
    ``language``, a column's name, the band of its value is used where there is one,
    else that of the script; scripts without a band have that of "other". Below
    ``MIN_TOKENS`` tokens the band's least entropy is scaled by log2 of their number.
    ``fallback_share`` is the share of bytes, white space left out, of characters that the vocabulary
    of ``pieces`` (``read_pieces``) lacks.

    A NULL or empty text has all counts and rates 0, script "" and fails the base rules.
    Rows are judged one by one, so repeated ones are repeated; no rows give none. Other
    columns are not read.
    """
    lang = F.col(language).cast("string") if language else F.lit(None).cast("string")
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
              + ", ".join(f"{c} long" for c in _COUNTS) + ", " + ", ".join(f"{c} double" for c in _RATES)
              + ", script string, base_failed boolean, kept boolean")
    return (docs.select("doc_id", text_or_empty().alias("text"), lang.alias("lang"))
            .mapInArrow(_judge(ranks, pattern, pieces, dict(bands)), schema))


def _judge(ranks: Broadcast, pattern: str, pieces: Broadcast, bands: dict[str, Band]) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = codec(ranks.value, pattern)
        known = frozenset(pieces.value).union(WHITE_SPACE)
        for batch in batches:
            rows = []
            for raw, lang in zip(texts_of(batch), batch.column(2).to_pylist()):
                text = raw.decode()
                base = base_counts(text, raw)
                script = main_script(text)
                ids = np.array(encode_text(encoding, text), dtype=np.int64)
                rates = fertility(text, ids, known)
                failed = base_failed(base)
                band = bands.get(lang) or bands.get(script) or bands["other"]
                rows.append((*base, len(ids), *rates, script, failed, not failed and fits(band, len(ids), rates)))
            columns = list(zip(*rows)) if rows else [()] * 12
            kinds = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", *_COUNTS, *_RATES, "script", "base_failed", "kept"])
    return run


def base_counts(text: str, raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = raw.split()
    blanks = sum(map(text.count, WHITE_SPACE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: Sequence[bytes]) -> int:
    """Words in windows of ``WINDOW`` words found twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + each[i:n + i]
        windows ^= windows >> np.uint64(29)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base_failed(base: Sequence[int]) -> bool:
    return base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEATED_PERCENT * base[0]


def main_script(text: str) -> str:
    """The script of most letters, "other" for one without a band, "" without letters.

    All letters of the text are counted; the script of each different one is looked up once.
    """
    if text.isascii():
        return "Latin" if any(map(str.isalpha, text)) else ""
    times = Counter(text)
    different = "".join(times)

    def count(kind: str) -> int:
        return sum(times[c] for c in regex.findall(rf"\p{{{kind}}}", different))

    counts = {script: count(script) for script in _SCRIPTS}
    letters = count("L")
    best = max(counts, key=counts.get)
    if counts[best]:
        return best if 2 * counts[best] >= letters else "other"
    return "other" if letters else ""


def fallback_share(text: str, known: frozenset[str]) -> float:
    """The share of a text's bytes that belong to characters not ``known``; white space counts for nothing."""
    missing = set(text) - known
    if not missing:
        return 0.0
    times = Counter(text)
    blanks = sum(times[c] for c in WHITE_SPACE)
    return sum(times[c] * len(c.encode()) for c in missing) / (len(text.encode()) - blanks)


def fertility(text: str, ids: np.ndarray, known: frozenset[str]) -> tuple[float, float, float]:
    """Characters per token, share that falls back to bytes, entropy of the tokens in bits."""
    if not len(ids):
        return 0.0, 0.0, 0.0
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    return len(text) / len(ids), fallback_share(text, known), float(-(share * np.log2(share)).sum())


def fits(band: Band, n_tokens: int, rates: Sequence[float]) -> bool:
    if not n_tokens:
        return True
    chars, fallback, entropy = rates
    least = band.min_entropy * min(1.0, np.log2(n_tokens) / np.log2(MIN_TOKENS))
    return (band.min_chars_per_token <= chars <= band.max_chars_per_token
            and fallback <= band.max_fallback and bool(entropy >= least))
