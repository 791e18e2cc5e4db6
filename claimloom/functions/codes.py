"""Synthetic diagnosis codes: a chapter letter, a two-digit family and a sequence of at least three digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.fixed_values import CHAPTERS

_LETTERS = "".join(CHAPTERS)


def make_diagnosis_code(number: Column) -> Column:
    """Code of the 1-based catalog number; letter and sequence together keep it unique."""
    zero_based = number.cast("bigint") - 1
    letter_at = (zero_based % len(_LETTERS) + 1).cast("int")
    sequence = F.call_function("div", zero_based, F.lit(len(_LETTERS)))
    digits = sequence.cast("string")
    return F.concat(
        F.substring(F.lit(_LETTERS), letter_at, F.lit(1)),
        F.lpad((sequence % 100).cast("string"), 2, "0"),
        F.lit("."),
        F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")),
    )


def diagnosis_chapter(letter: Column) -> Column:
    """Chapter name of a code's first letter; letters past the catalog share the last chapter."""
    *named, (_, fallback) = CHAPTERS.items()
    chapter = F.when(letter == named[0][0], named[0][1])
    for key, name in named[1:]:
        chapter = chapter.when(letter == key, name)
    return chapter.otherwise(fallback)
