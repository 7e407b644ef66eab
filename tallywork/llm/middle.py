"""Fill-in-the-middle: a text is cut at two boundaries and its parts are put in another order.

The places at which a text may be cut are a `BoundarySet` of byte offsets: the
starts of its units and its end. Units are code points, words (a word takes the
blanks after it) or lines. Two random numbers of a document choose two
boundaries, and `select` gives their offsets. Python sees a text only to build
its set; the parts are sliced and joined by column expressions.

A text is left plain if it is empty or null, if it holds a marker, or by chance.
Otherwise the markers occur once each in the output, so that the form and the
output give the text back exactly. Random numbers depend on the seed and the
document's id only: rows with equal ids, and all rows with a null id, have the
same ones. Repeated rows stay repeated. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tallywork.llm.boundaries import BoundarySet
from tallywork.llm.wording import as_bytes, word_spans

# The markers of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Of 100 documents so many are cut at most, and of 100 cut ones so many have the suffix first.
CUT, SUFFIX_FIRST = 90, 20
SEED = 1
CODE_POINT, WORD, LINE = "code point", "word", "line"


def unit_starts(data: bytes, unit: str = CODE_POINT) -> np.ndarray:
    """Byte offsets at which the text may be cut: where its units start, and its end."""
    codes = np.frombuffer(data, np.uint8)
    if unit == CODE_POINT:
        starts = np.flatnonzero((codes & 0xC0) != 0x80)
    elif unit == WORD:
        starts = word_spans(data)[0].copy()
        starts[:1] = 0
    elif unit == LINE:
        starts = np.flatnonzero(codes == 10) + 1
        starts = np.concatenate(([0], starts[starts < len(data)])) if data else starts
    else:
        raise ValueError(f"unknown unit {unit!r}")
    return np.append(starts, len(data))


def boundary_set(data: bytes, unit: str = CODE_POINT) -> BoundarySet:
    return BoundarySet.of(unit_starts(data, unit))


def boundary_sets(text: Column, unit: str = CODE_POINT) -> Column:
    """The set of each text as bytes, for tables that are cut again with other seeds."""
    @F.pandas_udf(BinaryType())
    def built(texts: pd.Series) -> pd.Series:
        return pd.Series([boundary_set(as_bytes(each), unit).to_bytes() for each in texts])

    return built(text)


_CUTS = StructType([StructField(name, LongType()) for name in ("n", "first", "second", "from_byte", "to_byte")])


def _chosen(found: BoundarySet, one: int, other: int) -> tuple[int, int, int, int, int]:
    """The number of units, and the two boundaries as numbers of units and as offsets."""
    one, other = sorted((one % len(found), other % len(found)))
    return len(found) - 1, one, other, found.select(one), found.select(other)


def cuts(text: Column, one: Column, other: Column, unit: str = CODE_POINT) -> Column:
    """A struct: `n` units, the boundaries `first` and `second`, and their offsets `from_byte` and `to_byte`."""
    @F.pandas_udf(_CUTS)
    def found(texts: pd.Series, ones: pd.Series, others: pd.Series) -> pd.DataFrame:
        rows = [_chosen(boundary_set(as_bytes(text), unit), a, b) for text, a, b in zip(texts, ones.tolist(), others.tolist())]
        return pd.DataFrame(rows, columns=_CUTS.names, dtype=np.int64)

    return found(text, one, other)


def stored_cuts(sets: Column, one: Column, other: Column) -> Column:
    """As `cuts`, from the bytes of `boundary_sets`."""
    @F.pandas_udf(_CUTS)
    def found(stored: pd.Series, ones: pd.Series, others: pd.Series) -> pd.DataFrame:
        rows = [_chosen(BoundarySet.from_bytes(bytes(each)), a, b) for each, a, b in zip(stored, ones.tolist(), others.tolist())]
        return pd.DataFrame(rows, columns=_CUTS.names, dtype=np.int64)

    return found(sets, one, other)


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2^32: the first hex groups of the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * n, 8), 16, 10).cast("long") for n in range(4)]


def transformed(
    docs: DataFrame, unit: str = CODE_POINT, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST,
    text: str = "text",
) -> DataFrame:
    """The documents with `n`, `form`, `prefix`, `middle`, `suffix` and `output`.

    The three parts are null where the form is plain. Columns of the input with
    these names are replaced.
    """
    added = ("n", "form", "prefix", "middle", "suffix", "output")
    own = [name for name in docs.columns if name not in added]
    whole = F.coalesce(F.col("_row._text"), F.lit(""))
    rows = docs.select(F.struct(*own, F.col(text).alias("_text")).alias("_row"), F.array(*draws(F.col("doc_id"), seed)).alias("_h"))
    rows = rows.select("*", cuts(F.col("_row._text"), F.col("_h")[0], F.col("_h")[1], unit).alias("_cut"))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole, F.lit(marker))
    form = F.when((whole == "") | marked | (F.col("_h")[2] % 100 >= cut), PLAIN).otherwise(
        F.when(F.col("_h")[3] % 100 < suffix_first, SPM).otherwise(PSM)
    )
    rows = rows.select("_row", "_cut", whole.alias("_whole"), form.alias("form"))

    def part(start: Column, end: Column) -> Column:
        piece = F.substring(F.encode("_whole", "UTF-8"), start.cast("int") + 1, (end - start).cast("int")).cast("string")
        return F.when(F.col("form") != PLAIN, piece)

    start, end = F.col("_cut.from_byte"), F.col("_cut.to_byte")
    rows = rows.select(
        "_row", "_whole", "form", F.col("_cut.n").alias("n"), part(F.lit(0), start).alias("prefix"), part(start, end).alias("middle"),
        part(end, F.octet_length("_whole")).alias("suffix"),
    )
    first = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    other = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == PSM, first).when(F.col("form") == SPM, other).otherwise(F.col("_whole"))
    return rows.select(*[F.col(f"_row.{name}") for name in own], "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    def between(after: str, before: str) -> Column:
        rest = F.substring_index(output, after, -1)
        return F.substring_index(rest, before, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
