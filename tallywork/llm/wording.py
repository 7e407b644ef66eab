"""Words, windows and keys of texts: column expressions, and numpy forms for Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the blanks that end a word, U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())

_ODD = np.uint64(0x9E3779B97F4A7C15)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later expressions read instead of repeating it.

    A generator's output is not merged into the expressions above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def words(text: Column) -> Column:
    """Words between blanks, in order; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, all other characters as they are.

    `lower` does just that in a text of one byte per character, and is faster.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def as_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def _powers(base: np.uint64, count: int) -> np.ndarray:
    values = np.full(count, base, np.uint64)
    if count:
        values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS.encode())] = True


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte string."""
    inside = ~_IS_BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


_PIECE = 1 << 20


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: equal spans have equal hashes.

    Spans are in order and apart. Time is linear in the bytes; memory is that of
    about 1 MB of them, or of the longest span.
    """
    found, at = [], 0
    while at < len(starts):
        first = int(starts[at])
        end = max(at + 1, int(np.searchsorted(ends, first + _PIECE, "right")))
        codes = np.frombuffer(data, np.uint8, int(ends[end - 1]) - first, first).astype(np.uint64)
        codes += np.uint64(1)
        up, back = _powers(_ODD, len(codes)), _powers(_INVERSE, len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up, out=sums[1:])
        begin, stop = starts[at:end] - first, ends[at:end] - first
        found.append(mixed((sums[stop] - sums[begin]) * back[begin] + (stop - begin).astype(np.uint64)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each `size` consecutive values."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_ODD, len(values)), out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * _powers(_INVERSE, len(values) - size + 1))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each `size` consecutive values, by doubling the width."""
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (size - width)], values[size - width :]) if size > width else values
