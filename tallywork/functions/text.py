"""Text rules of JVM string programs, as Spark column expressions.

Spark SQL differs from `java.lang.String` in three ways that change results on
dirty input: `trim` keeps control characters, `split` keeps trailing empty
strings, and numeric casts tolerate surrounding blanks. Everything here stays
inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: every character up to and including U+0020 counts as blank.
BLANKS = "".join(chr(code) for code in range(0x21))
# Fixed value: the characters of the regex class `\s`.
WHITESPACE = " \t\n\x0b\f\r"


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and expressions will not recompute.

    The optimizer moves a filter on a plain projected column below the
    projection and repeats the column's expression there. It cannot do so with
    the output of a generator, so the value is generated as a one-element list.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def java_trim(text: Column) -> Column:
    """Strip all characters <= U+0020 from both ends (Spark's trim strips spaces only)."""
    return F.btrim(text, F.lit(BLANKS))


def non_blank(text: Column) -> Column:
    """True for text that is neither null nor blank."""
    return F.coalesce(F.length(java_trim(text)) > 0, F.lit(False))


def java_split(text: Column, delimiters: str, runs: bool = False) -> Column:
    """Split on any of the given characters and drop trailing empty strings.

    `runs=True` treats several delimiters in a row as one. Text made of
    delimiters only gives no fields; empty text gives one empty field.
    """
    head = F.rtrim(text, F.lit(delimiters))
    nothing_left = (F.length(head) == 0) & (F.length(text) > 0)
    return F.when(nothing_left, F.array().cast("array<string>")).otherwise(
        F.split(head, _pattern(delimiters, runs))
    )


def record_fields(text: Column, delimiters: str) -> Column:
    """Fields of a trimmed record, trailing empty ones dropped.

    Differs from `java_split` for records made of delimiters only, which get one
    empty field instead of none; either is too short for a record, and the text
    is worked through only once.
    """
    record = java_trim(text)
    if not set(delimiters) <= set(BLANKS):
        record = F.rtrim(record, F.lit(delimiters))
    return F.split(record, _pattern(delimiters))


def _pattern(delimiters: str, runs: bool = False) -> str:
    if delimiters == WHITESPACE:
        one = r"\s"
    elif len(delimiters) == 1:
        one = re.escape(delimiters)
    else:
        one = f"[{re.escape(delimiters)}]"
    return f"{one}+" if runs else one


def has_fields(parts: Column, count: int) -> Column:
    """Whether split parts are exactly `count` fields once trailing empty ones are dropped.

    For delimiters of several characters, such as `::`: the split starts from
    the left, so a run of them cannot be cut off the right end beforehand.
    """
    size = F.size(parts)
    rest_is_empty = F.array_join(F.slice(parts, F.lit(count + 1), F.greatest(size - count, F.lit(0))), "") == ""
    return (size >= count) & (F.get(parts, F.lit(count - 1)) != "") & ((size == count) | rest_is_empty)


def typed(text: Column, type_name: str, strict: bool = True) -> Column:
    """Text to number; unreadable text fails the job when strict, else gives null.

    Null stays null in both modes. Integers with blanks around them count as
    unreadable. The result does not depend on `spark.sql.ansi.enabled`.
    """
    value = text.try_cast(type_name)
    if type_name in ("int", "bigint"):
        value = F.when(text == java_trim(text), value)
    if not strict:
        return value
    complaint = F.concat(F.lit(f"not a valid {type_name}: "), text)
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(complaint).cast(type_name)))
