"""Column expressions on texts that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Words between blanks, and words of letters and digits in lowered text.
BLANK_WORD = r"[^\x20\x09-\x0D]+"
TEXT_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_az(text: Column) -> Column:
    """``text`` with the letters A-Z in lower case and all others as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def blank_words(text: Column) -> Column:
    """Words between blanks; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(BLANK_WORD), F.lit(0))


def text_words(text: Column) -> Column:
    """Words of letters, digits and characters beyond ASCII, A-Z lowered; none for null."""
    return F.regexp_extract_all(lower_az(F.coalesce(text, F.lit(""))), F.lit(TEXT_WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row.

    Functions on arrays evaluate what they capture at each element, so a large
    array is bound to a variable before it is indexed.
    """
    return F.transform(F.array(value), body)[0]


def positions(start: Column | int, stop: Column) -> Column:
    """The integers from ``start`` to ``stop`` - 1; empty if there are none.

    (A descending ``sequence`` would otherwise appear for an empty range.)
    """
    first = F.lit(start) if isinstance(start, int) else start
    return F.when(stop > first, F.sequence(first, stop - 1)).otherwise(F.expr("array()").cast("array<int>"))


def running(values: Column, both: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """``both`` of all elements up to each one, as of 1, 2, 4, ... of them.

    Bind a large array with ``let`` first.  ``both`` is a sum, a largest value or
    the like; the work is n log n, where a fold that appends copies n times.
    """
    step = lambda k: F.call_function("shiftleft", F.lit(1), k)
    levels = F.sequence(F.lit(0), F.length(F.bin(F.size(values))))
    return F.aggregate(levels, values, lambda a, k: F.transform(a, lambda x, i: F.when(i >= step(k), both(x, a[i - step(k)])).otherwise(x)))


def hex_sha256(text: Column) -> Column:
    """Lower-case hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)
