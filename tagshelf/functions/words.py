"""Expressions that turn text and phrases into words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.split() and str.strip() see it: Unicode white
# space plus the four ASCII separators.
_SPACE = r"[\s\x1c-\x1f]"
_SPACES = rf"(?U){_SPACE}+"
_OUTER_SPACES = rf"(?U)^{_SPACE}+|{_SPACE}+$"


def strip(text: str | Column) -> Column:
    """``text`` without white space of any kind at either end."""
    return F.regexp_replace(text, _OUTER_SPACES, "")


def split_words(text: str | Column) -> Column:
    """The white-space-separated words of ``text``; blank text gives an empty array."""
    return F.array_remove(F.split(text, _SPACES), "")


def spaced(text: str | Column) -> Column:
    """``text`` with a space for each hyphen."""
    return F.replace(text, F.lit("-"), F.lit(" "))


def distinct_words(phrases: str | Column) -> Column:
    """The distinct lower-case words of an array of phrases, sorted; a hyphen separates words."""
    return F.sort_array(F.array_distinct(split_words(F.lower(spaced(F.array_join(phrases, " "))))))


def without_stop_words(tokens: str, stop_words: Sequence[str]) -> Column:
    """The elements of column ``tokens`` that are not in ``stop_words``, order kept."""
    if not stop_words:
        return F.col(tokens)
    # As one SQL text: a literal Column per stop word takes long to build.
    listed = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in stop_words)
    return F.expr(f"filter(`{tokens}`, word -> word not in ({listed}))")


def ascii_name_words(name: str | Column) -> Column:
    """Words of a product name: lower case, everything but a-z and spaces deleted.

    A deleted letter does not split a word: ``crème`` gives ``crme``. Some
    elements are empty, as spaces in a row are not merged.
    """
    return F.split(F.regexp_replace(F.lower(name), "[^a-zA-Z ]+", ""), " ")


def text_words(text: str | Column) -> Column:
    """Lower-case runs of letters and digits, repeats kept."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
