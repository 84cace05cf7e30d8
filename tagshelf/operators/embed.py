"""Word vectors, and products embedded as the mean of their word vectors.

A table of word vectors has the columns ``word`` (unique) and ``vector``
(``array<double>``, all of one length). It is taken to be stored: it is read
more than once.
"""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import norm
from ..sources.scratch import materialize
from .lookup import lookup_join

# Tasks that train word vectors, whatever the cluster.
NUM_PARTITIONS = 16
# Words that the driver may have to hold while it trains.
MAX_WORDS = 1_000_000


class VocabularyError(ValueError):
    """More words would be trained than the driver is to hold; ``min_count`` is one that would fit."""

    def __init__(self, words: int, max_words: int, min_count: int):
        super().__init__(f"{words} words to train, {max_words} allowed: min_count={min_count} fits,"
                         " or allow more with max_words")
        self.words, self.max_words, self.min_count = words, max_words, min_count


def fit_word_model(df: DataFrame, tokens: str = "tokens", *, vector_size: int = 100,
                   min_count: int = 1, window_size: int = 5, max_iter: int = 1,
                   step_size: float = 0.025, seed: int = 42,
                   num_partitions: int = NUM_PARTITIONS, max_words: int = MAX_WORDS) -> Word2VecModel:
    """Train Spark ML's Word2Vec on the ``tokens`` of ``df``.

    Training runs in ``num_partitions`` tasks, whose vectors are averaged, so the
    number is part of the result: it is fixed and follows no setting of the
    cluster. What one number and one seed give repeats only for the same rows in
    the same input partitions. A caller with more cores may raise it, and
    ``max_iter`` with it, since each pass sees a smaller share of the rows.

    The driver holds the whole vocabulary of words that occur ``min_count`` times, and
    its vectors: 8 bytes x ``vector_size`` per word and a few copies of it, about
    3 GB for a million words of 100. So words are counted first, by the executors; where
    there are more than ``max_words``, ``VocabularyError`` tells the ``min_count`` that would do.
    """
    check_vocabulary(df, tokens, min_count, max_words)
    trainer = Word2Vec(inputCol=tokens, outputCol="embedding", vectorSize=vector_size,
                       minCount=min_count, windowSize=window_size, maxIter=max_iter,
                       stepSize=step_size, seed=seed, numPartitions=num_partitions)
    return trainer.fit(df.select(tokens).filter(F.col(tokens).isNotNull()))


def check_vocabulary(df: DataFrame, tokens: str = "tokens", min_count: int = 1, max_words: int = MAX_WORDS) -> int:
    """How many words occur ``min_count`` times or more; ``VocabularyError`` if that is over ``max_words``."""
    counts = df.select(F.explode(tokens).alias("word")).groupBy("word").count().filter(F.col("count") >= min_count)
    # One row per number of occurrences: few, whatever the number of words.
    sizes = counts.groupBy("count").agg(F.count(F.lit(1)).alias("words"))
    rows = sizes.orderBy(F.desc("count")).toLocalIterator()
    held = fitting = 0
    least = None
    for row in rows:
        held += row["words"]
        if held <= max_words:
            fitting = row["count"]
        elif least is None:
            least = row["count"]
    if held > max_words:
        raise VocabularyError(held, max_words, fitting or least + 1)
    return held


def word_vectors(model: Word2VecModel) -> DataFrame:
    """The word vectors of a trained model."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def embed_with_model(df: DataFrame, model: Word2VecModel, tokens: str = "tokens") -> DataFrame:
    """Add ``embedding`` and ``norm`` from a trained model, row by row without a shuffle.

    The sum of the known words' vectors is divided by the number of all tokens.
    A row with NULL tokens counts as one without tokens and gets a zero vector.
    Spark ML broadcasts the whole vocabulary for it, whatever its size; for a
    large one use ``embed_rows`` with the stored ``word_vectors``.
    """
    applied = model.copy().setInputCol("_tokens").setOutputCol("_embedding")
    filled = df.withColumn("_tokens", F.coalesce(tokens, F.array().cast("array<string>")))
    embedded = applied.transform(filled).withColumn("embedding", vector_to_array("_embedding"))
    return with_norm(embedded.drop("_tokens", "_embedding"))


def embed_rows(df: DataFrame, vectors: DataFrame, tokens: str = "tokens",
               **join_options: int) -> DataFrame:
    """Add ``embedding`` and ``norm`` from any table of word vectors.

    The result is that of ``embed_with_model``. Rows with equal tokens have equal
    embeddings, so the vectors are joined and averaged once for each distinct
    token list and then looked up for the rows, which are not exploded.
    """
    size = vector_size(vectors)
    # explode_outer, as a plain explode adds a filter that computes the tokens again.
    words = df.select(tokens).distinct().select(tokens, F.explode_outer(tokens).alias("word"))
    found = lookup_join(words, vectors.select("word", "vector"), "word", "inner", stored=True, **join_options)
    totals = found.groupBy(tokens).agg(*_element_sums(size))
    means = totals.select(tokens, _divided(size, F.size(tokens)).alias("embedding"))
    embedded = lookup_join(df, means, tokens, "left", **join_options)
    zero = F.array_repeat(F.lit(0.0), size)
    return with_norm(embedded.withColumn("embedding", F.coalesce("embedding", zero)))


def embed_changed(df: DataFrame, stored: DataFrame, vectors: DataFrame, key: str = "url",
                  tokens: str = "tokens", **join_options: int) -> DataFrame:
    """``embed_rows`` for a delivery of which most rows are in a ``stored`` catalogue already.

    ``stored`` has ``key``, ``tokens``, ``embedding`` and ``norm``, made with the same ``vectors``. A row
    whose key and hash of tokens stand there takes over what is stored; only the others are embedded.
    Rows without a key are. ``df`` is read twice: store it first.
    """
    # A stored key may be there more than once; equal tokens have equal embeddings.
    known = stored.filter(F.col(key).isNotNull()).select(_row_key(key, tokens), "embedding", "norm")
    known = known.groupBy("_row").agg(*[F.any_value(c).alias(c) for c in ("embedding", "norm")])
    asked = df.withColumn("_row", F.when(F.col(key).isNotNull(), _row_key(key, tokens)))
    placed = materialize(lookup_join(asked, known, "_row", "left", **join_options).drop("_row"))
    kept = placed.filter(F.col("norm").isNotNull())
    changed = placed.filter(F.col("norm").isNull()).drop("embedding", "norm")
    return kept.unionByName(embed_rows(changed, vectors, tokens, **join_options))


def _row_key(key: str, tokens: str) -> Column:
    """What tells a row of a catalogue and its tokens: 96 bits of hash beside the key."""
    return F.struct(F.col(key).alias("key"), F.xxhash64(tokens).alias("a"), F.hash(tokens).alias("b"),
                    F.size(tokens).alias("n")).alias("_row")


def mean_vectors(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The mean of column ``vector`` per ``keys``, as ``vector``."""
    totals = df.groupBy(*keys).agg(F.count("vector").alias("n"),
                                   *_element_sums(size))
    return totals.select(*keys, _divided(size, F.col("n")).alias("vector"))


def vector_size(vectors: DataFrame) -> int:
    """Length of the vectors in a table of word vectors."""
    row = vectors.select(F.size("vector")).first()
    if row is None:
        raise ValueError("the table of word vectors is empty")
    return row[0]


def with_norm(df: DataFrame) -> DataFrame:
    """Add ``norm``, the length of ``embedding``, stored so that no search computes it again."""
    return df.withColumn("norm", norm("embedding"))


def _element_sums(size: int) -> list[Column]:
    """One plain sum per element: these stay in the hash aggregate, as an array would not."""
    return [F.expr(f"sum(vector[{i}]) as s{i}") for i in range(size)]


def _divided(size: int, by: Column) -> Column:
    sums = F.expr(f"array({', '.join(f's{i}' for i in range(size))})")
    return F.transform(sums, lambda total: total / by)
