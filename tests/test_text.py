from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from rows import column
from tallywork.functions import text


def java_split(value: str, pattern: str) -> list[str]:
    """What a JVM program gets from `split`."""
    if not re.search(pattern, value, re.ASCII):
        return [value]
    parts = re.split(pattern, value, flags=re.ASCII)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_trim(value: str) -> str:
    return value.strip("".join(map(chr, range(0x21))))


EDGES = ["", " ", "\t", " a", "\ta b", "a  b", "a,b,,", ",,,", ",a", "a\x01 ", "é ü\xa0", "x::y::::", "::", ":::", "a:::"]


def texts(alphabet: str) -> list[str]:
    dice = random.Random(7)
    made = ["".join(dice.choice(alphabet) for _ in range(dice.randrange(12))) for _ in range(300)]
    return sorted(set(EDGES + made))


def test_trim(lines):
    values = texts(" \t\x01\x1fab ")
    got = column(lines(*values).select(text.java_trim(F.col("value")).alias("v")), "v")
    assert got == [java_trim(value) for value in values]


@pytest.mark.parametrize(
    ("delimiters", "pattern", "runs"),
    [(",", ",", False), ("|", r"\|", False), (text.WHITESPACE, r"\s", False), (text.WHITESPACE, r"\s+", True), (",;", "[,;]", False)],
)
def test_split(lines, delimiters, pattern, runs):
    values = texts("a,|; \t")
    got = column(lines(*values).select(text.java_split(F.col("value"), delimiters, runs).alias("v")), "v")
    assert got == [java_split(value, pattern) for value in values]


@pytest.mark.parametrize(("delimiters", "pattern"), [(",", ","), ("|", r"\|"), (text.WHITESPACE, r"\s")])
def test_record_fields_agree_from_two_fields_on(lines, delimiters, pattern):
    values = texts("a,| \t\x01")
    got = column(lines(*values).select(text.record_fields(F.col("value"), delimiters).alias("v")), "v")
    for value, fields in zip(values, got):
        wanted = java_split(java_trim(value), pattern)
        assert fields == wanted or max(len(fields), len(wanted)) < 2


@pytest.mark.parametrize("count", [1, 2, 3, 4])
def test_wide_delimiter(lines, count):
    values = [*texts("a:"), "a::b::c::d", "a::b::c::d::::", "a::b::c", "::::::d", "a::b::c::d::::e"]
    frame = text.computed_once(lines(*values), "p", F.split("value", "::"))
    got = column(frame.select(text.has_fields(F.col("p"), count).alias("v")), "v")
    for value, fits in zip(values, got):
        fields = java_split(value, "::")
        assert fits == (len(fields) == count) or fields == [""], value


def test_typed_drop(lines):
    frame = lines("7", " 7", "x", "", "2147483648", None, "1.5").select(
        text.typed(F.col("value"), "int", strict=False).alias("i"),
        text.typed(F.col("value"), "double", strict=False).alias("d"),
    )
    assert column(frame, "i") == [7, None, None, None, None, None, None]
    assert column(frame, "d") == [7.0, 7.0, None, None, 2147483648.0, None, 1.5]


@pytest.mark.parametrize("bad", ["x", " 7", ""])
def test_typed_strict_fails(lines, bad):
    with pytest.raises(Exception, match="not a valid int"):
        lines(bad).select(text.typed(F.col("value"), "int")).collect()


def test_typed_strict_keeps_null(lines):
    assert column(lines(None, "3").select(text.typed(F.col("value"), "int").alias("v")), "v") == [None, 3]


def test_non_blank(lines):
    assert column(lines("a", " \t\x02", "", None).select(text.non_blank(F.col("value")).alias("v")), "v") == [
        True, False, False, False,
    ]
