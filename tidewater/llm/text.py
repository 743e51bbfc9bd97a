"""Text expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything that ends a word: ASCII other than digits and lower-case letters.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The white space that text equality ignores.
BLANKS = " \t\n\x0b\x0c\r"


def text_or_empty(text: str | Column) -> Column:
    """The text, and an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def spaced_words(text: Column) -> Column:
    """The words of a text, two spaces between each two, nothing outside."""
    return F.trim(F.regexp_replace(lower_ascii(text), NON_WORD, "  "))


def count_spaced(spaced: Column) -> Column:
    """How many words ``spaced_words`` has left."""
    gaps = (F.char_length(spaced) - F.char_length(F.replace(spaced, F.lit("  "), F.lit("")))) / 2
    return F.when(spaced == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def word_array(spaced: Column) -> Column:
    """The words as an array; empty for a text without words."""
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, "  "))


def squeezed(text: Column) -> Column:
    """The text without white space of ``BLANKS``."""
    return F.translate(text, BLANKS, "")
