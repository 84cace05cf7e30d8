"""Ingredients from free text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.spans import phrase_counts, phrase_levels, without_overlaps
from ..functions.tags import elements
from ..functions.words import strip, text_words
from ..sources.scratch import materialize
from ..sources.sizes import row_bytes
from .lookup import BROADCAST_BYTES, lookup_join

# Entries are sent to the tasks up to this many bytes of their rows.
SENT_BYTES = 16 * 1024 * 1024


def split_ingredients(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per comma-separated part: the key, its position from 0, and ``ingredient``.

    Parts are stripped and lower-cased; blank ones are left out, and the
    positions of the others stay as they were.
    """
    parts = df.select(key, F.posexplode(elements(text)).alias("pos", "part"))
    return (parts.select(key, "pos", F.lower(strip("part")).alias("ingredient"))
            .filter(F.col("ingredient") != ""))


def split_phrases(texts: DataFrame, longest: int, text: str = "text") -> DataFrame:
    """Phrases of 1, 2, ... ``longest`` words, one behind the other, over and over, as ``word``.

    The words of a text are divided anew after each phrase of ``longest`` words; phrases that its
    end cuts off are left out.
    """
    span = longest * (longest + 1) // 2
    worded = texts.select(text_words(text).alias("words")).filter(F.size("words") > 0)
    starts = worded.select("words", F.explode(F.sequence(F.lit(0), F.size("words") - 1, F.lit(span))).alias("start"))
    sized = starts.select("words", "start", F.explode(F.sequence(F.lit(1), F.lit(longest))).alias("n"))
    begin = (F.col("start") + F.expr("n * (n - 1) div 2") + 1).cast("int")
    return (sized.filter(begin + F.col("n") - 1 <= F.size("words"))
            .select(F.array_join(F.slice("words", begin, F.col("n")), " ").alias("word")))


def vocabulary_entries(vocab: DataFrame, word: str = "word") -> DataFrame:
    """The distinct entries of ``vocab`` as they are looked for: (word, first, n_words).

    An entry is its lower-case words with one blank between them; one without a word is left out.
    """
    words = vocab.select(text_words(word).alias("words")).filter(F.size("words") > 0)
    return words.select(F.array_join("words", " ").alias("word"), F.element_at("words", 1).alias("first"),
                        F.size("words").alias("n_words")).distinct()


def match_vocabulary(texts: DataFrame, vocab: DataFrame, keys: list[str],
                     text: str = "text", **join_options: int) -> DataFrame:
    """Which entries of ``vocab`` (column ``word``) occur in each text, and how often: keys, ``word``, ``count``.

    An entry may have several words, which have to follow each other in the text; what stands
    between them that is no letter or digit does not matter. Where entries overlap, the one that
    begins first is taken, of those that begin at one place the longest; the next one begins
    behind it. So in "olive oil" an entry "olive" is not found beside "olive oil".

    A vocabulary with entries of several words is sent to the tasks up to ``SENT_BYTES``; each text
    is then read within one task, and only its counts are shuffled. Of a larger one, a place in a
    text is kept if its word begins an entry, with no more of the words that follow than the longest
    entry has, then compared with the entries of each length there is for that word. Only what matches
    is shuffled: by text for the overlaps, by entry for the counts. With a vocabulary of single words
    there are none.
    """
    entries = materialize(vocabulary_entries(vocab))
    longest = entries.agg(F.max("n_words")).first()[0] or 1
    if longest == 1:
        words = texts.select(*keys, F.explode(text_words(text)).alias("word"))
        known = lookup_join(words, entries.select("word"), "word", "left_semi", stored=True, **join_options)
    elif row_bytes(entries) <= min(SENT_BYTES, join_options.get("broadcast_bytes", BROADCAST_BYTES)):
        return _counted(texts, entries, keys, text)
    else:
        found = _phrases(texts, entries, keys, text, longest, join_options)
        known = _taken(found, keys)
    return known.groupBy(*keys, "word").count()


def _counted(texts: DataFrame, entries: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, word, count) with the entries sent to the tasks."""
    listed = entries.select("word").toArrow().column(0).combine_chunks()
    sent = texts.sparkSession.sparkContext.broadcast(phrase_levels(listed))
    worded = texts.select(text_words(text).alias("_words"), *keys).filter(F.size("_words") > 0)
    schema = StructType([*[worded.schema[k] for k in keys], entries.schema["word"], StructField("count", LongType())])
    counts = worded.mapInArrow(phrase_counts(sent, schema.names), schema)
    return counts.groupBy(*keys, "word").agg(F.sum("count").alias("count"))


def _phrases(texts: DataFrame, entries: DataFrame, keys: list[str], text: str, longest: int,
             join_options: dict[str, int]) -> DataFrame:
    """(keys, _text, _place, _length, word) of every entry at every place it stands at."""
    lengths = entries.groupBy("first").agg(F.array_sort(F.collect_set("n_words")).alias("_lengths"))
    # One id per key and text. Rows that have both in common are told apart by neither.
    worded = texts.select(*keys, F.xxhash64(*keys, text).alias("_text"), text_words(text).alias("_words"))
    ahead = F.transform("_words", lambda word, i: F.struct(
        word.alias("first"), i.alias("_place"), F.slice("_words", i + 1, longest).alias("_ahead")))
    places = worded.select(*keys, "_text", F.inline(ahead))
    begun = lookup_join(places, lengths, "first", "inner", **join_options)
    phrases = (begun.select(*keys, "_text", "_place", "_ahead", F.explode("_lengths").alias("_length"))
               .filter(F.col("_length") <= F.size("_ahead"))
               .select(*keys, "_text", "_place", "_length",
                       F.array_join(F.slice("_ahead", F.lit(1), F.col("_length")), " ").alias("word")))
    return lookup_join(phrases, entries.select("word"), "word", "left_semi", stored=True, **join_options)


def _taken(found: DataFrame, keys: list[str]) -> DataFrame:
    """The matches that are left of overlapping ones."""
    ordered = (found.select("_text", "_place", "_length", *keys, "word").repartition("_text")
               .sortWithinPartitions("_text", "_place", F.desc("_length")))
    names = [*keys, "word"]
    return ordered.mapInArrow(without_overlaps(names), StructType([found.schema[n] for n in names]))
