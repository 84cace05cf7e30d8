"""Byte-level BPE: encode whole texts by a rank file, and decode ids to raw bytes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from .common import ArrowFunction, by_value, id_and_text, texts_of

by_value(__name__)

# Texts longer than this are cut at safe boundaries before they are encoded.
PIECE_CHARS = 50_000
# Between a letter or digit and a space or line break no match of the pattern goes on,
# and no alternative looks back: what is left and right of it is matched as if alone.
SAFE_BOUNDARY = r"(?<=[\p{L}\p{N}])(?=[ \n])"


def read_ranks(spark: SparkSession, path: str) -> Broadcast:
    """A rank file (base64 token and rank per line) read on the driver and sent to all executors.

    Its size is that of a vocabulary, whatever the data; one over 64 MB is refused.
    """
    with open(path, "rb") as file:
        content = file.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} is no rank file: {len(content)} bytes")
    return spark.sparkContext.broadcast(content)


def encode(docs: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for each row of (doc_id, text); a NULL text has no ids."""
    return id_and_text(docs).mapInArrow(_encoder(ranks, pattern), _schema(docs, "ids array<int>"))


def decode(ids: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """(doc_id, bytes binary) for each row of (doc_id, ids); NULL ids give no bytes."""
    return ids.select("doc_id", "ids").mapInArrow(_decoder(ranks, pattern), _schema(ids, "bytes binary"))


def digests(docs: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each text encoded and decoded again.

    One pass, row by row, without a shuffle: ids are not kept. ``ids_sha256`` is over the
    decimal ids joined by commas. A NULL or empty text has no tokens, and both digests
    are those of nothing. Repeated rows give repeated rows, no rows none.
    """
    return id_and_text(docs).mapInArrow(
        _digester(ranks, pattern), _schema(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string"))


def _schema(df: DataFrame, more: str) -> str:
    return f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {more}"


def codec(content: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` cut at safe boundaries into pieces of at least ``size`` characters, but for the last."""
    boundary = regex.compile(SAFE_BOUNDARY)
    start = 0
    while len(text) - start > size and (found := boundary.search(text, start + size)):
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


def encode_text(encoding: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return encoding.encode_ordinary(text)
    return [i for piece in pieces(text) for i in encoding.encode_ordinary(piece)]


def _encoder(ranks: Broadcast, pattern: str) -> ArrowFunction:
    def run(batches):
        encoding = codec(ranks.value, pattern)
        for batch in batches:
            ids = [encode_text(encoding, t.decode()) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return run


def _decoder(ranks: Broadcast, pattern: str) -> ArrowFunction:
    def run(batches):
        encoding = codec(ranks.value, pattern)
        for batch in batches:
            found = [encoding.decode_bytes(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "bytes"])
    return run


def _digester(ranks: Broadcast, pattern: str) -> ArrowFunction:
    def run(batches):
        encoding = codec(ranks.value, pattern)
        names = [str(i) for i in range(encoding.n_vocab)]
        for batch in batches:
            counts, sent, back = [], [], []
            for text in texts_of(batch):
                ids = encode_text(encoding, text.decode())
                counts.append(len(ids))
                sent.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                back.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sent, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run
