"""Slices and predicates of text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a message as positive, and the width of the
# epoch-millisecond stamp at the start of a message.
POSITIVE_WORDS = ("cool", "great")
STAMP_WIDTH = 13


def stamp(text: Column, width: int = STAMP_WIDTH) -> Column:
    """The leading integer of fixed width; NULL when it is not all digits.

    A sign is allowed, blanks and line ends are not.
    """
    head = F.substring(text, 1, width)
    return F.when(head.rlike(r"\A[+-]?[0-9]+\z"), head.try_cast("bigint"))


def after_stamp(text: Column, width: int = STAMP_WIDTH) -> Column:
    """All text behind the stamp and its separator; empty when there is none."""
    return F.substring(text, width + 2, 2_147_483_647)


def contains_any(text: Column, words: Sequence[str] = POSITIVE_WORDS) -> Column:
    """True when any of the words occurs, also inside other words; case counts."""
    if not words:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(word)) for word in words])
