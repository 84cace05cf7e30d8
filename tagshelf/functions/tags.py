"""Expressions over tag strings: comma-separated ``lang:slug`` elements in one string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elements(tags: str | Column) -> Column:
    """The elements of a tag string as an array, spaces kept as they are."""
    return F.split(tags, ",")


def has_non_english(tags: str | Column) -> Column:
    """True where some element, once trimmed of spaces, does not start with ``en:``.

    A NULL string has no elements and gives False; an empty string has one
    (empty) element and gives True.
    """
    found = F.exists(elements(tags), lambda tag: ~F.trim(tag).startswith("en:"))
    return F.coalesce(found, F.lit(False))


def english_slugs(tags: str | Column) -> Column:
    """The ``en:`` elements without that marker; elements are not trimmed first.

    Every occurrence of ``en:`` inside an element goes, not only the leading
    one, so ``en:chicken:thigh`` becomes ``chickthigh``.
    """
    english = F.filter(elements(tags), lambda x: x.startswith("en:"))
    return F.transform(english, lambda x: F.replace(x, F.lit("en:"), F.lit("")))


def in_country(tags: str | Column, country: str, match: str = "contains") -> Column:
    """Does a country tag string name ``country``?

    ``match="contains"`` looks for the text ``en:<country>`` anywhere, so ``fr``
    also finds ``en:french-guiana``; it is a plain substring, which Spark pushes
    to a Parquet scan. ``match="element"`` asks for a whole element.
    """
    column = F.col(tags) if isinstance(tags, str) else tags
    if match == "contains":
        return column.contains(f"en:{country}")
    if match == "element":
        return F.array_contains(F.transform(elements(column), lambda tag: F.trim(tag)), f"en:{country}")
    raise ValueError(f"match must be 'contains' or 'element', not {match!r}")
