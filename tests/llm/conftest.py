import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF_DIR):
        pytest.skip("the given tables are absent")
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf):
    """doc_id to text of the given documents."""
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


PROSE = " ".join(f"word{i % 97}x{i % 13}" for i in range(80))
# Nulls, empty texts, ties, repeated rows, one id with two texts, a very long text, odd white space.
EDGE = [(None, None), (None, PROSE), (1, None), (2, ""), (3, PROSE), (3, PROSE), (4, PROSE), (5, "A\x0bb\u00a0c \u3000d\n"),
        (6, "x " * 150_000), (7, "a" * 3_000), (8, PROSE + " tail"), (8, "other text of the same id"), (9, "\n\n \n"),
        (10, "You idiot, you are a worthless clown.\n" * 3)]
# Columns whose names the operators use themselves.
CLASHES = ("key", "span", "row", "doc", "fp", "line", "leaked", "kept", "dropped", "n_lines", "features", "words",
           "component_id", "score", "item_id", "lang", "label")


@pytest.fixture(scope="session")
def edge_docs(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(EDGE, "doc_id long, text string")
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def ranks(spark):
    import public_tokenizers
    from tagshelf.llm import bpe
    return bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="session")
def pieces(spark):
    import public_tokenizers
    from tagshelf.llm import quality
    return quality.read_pieces(spark, public_tokenizers.path("piece_bpe_32k.model"))
