"""Similar sets across groups, none missed: covered sets, then prefixes of ordered sets.

Sets of n and m hashes are similar from a Jaccard similarity of 4/5, that is if
they share 4/9 of n + m. Then n // 5 hashes of a set at most are missing in the
other. Sets that are in one group already need no comparison. So a set has a
similar one in another group only if all but n // 5 of its hashes are shared,
that is found in sets of several groups. Three steps, each exact:

1. Of the hashes in the lowest third of their range all but n // 5 must be
   shared. Most sets end here, and rows are in proportion to the hashes.
2. Of the others' hashes, all of them, all but n // 5 must be shared.
3. In any one order of all hashes, the first hash that two similar sets share is
   among the first n // 5 + 1 of one and m // 5 + 1 of the other. The order is by
   the number of sets with the hash, those of one group only first, so that
   common passages are keys only of texts that have little else. Pairs with a
   common key are candidates, unless the shorter rest from the key on is too
   little.

A few hashes that many texts share count as shared in the first step without
being looked up. The list of them decides the cost only.

The sets of the largest group of a key are compared with all others, and the
others with each other. Each side is cut into lanes, and every lane of one meets
every lane of the other, so no key is held or compared by one task. The work is
that of all pairs of a key between groups: the price of missing none where many
unlike texts share nearly all their words.

Candidates are then compared by parities: a set has a bit for each of some
places, which says if an odd number of its hashes falls there. Two sets differ
in at least as many hashes as bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tallywork.llm.scratch import Scratch
from tallywork.llm.simhash import shingle_hashes
from tallywork.llm.wording import as_bytes

# Fixed value: of similarity 4/5 follows that a fifth of a set may be missing.
KEYED = 5
OFTEN = 4  # texts of a chunk that name a hash as frequent
CHUNK = 1 << 20  # hashes looked at together for it
LISTED = 1 << 15  # frequent hashes that count as shared without a look
LOWEST = np.uint64((1 << 64) // 3)  # hashes of the first step
STEP = 1000  # sets or pairs that a task holds as arrays at once
LANE = 200  # sets of a lane
PLACES = 1 << 14  # places of a parity at most


def frequent(sets: list[np.ndarray]) -> list[int]:
    """The hashes that several of the sets have."""
    values, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0))
    return values[counts >= OFTEN].view(np.int64).tolist()


def listed_hashes(named: DataFrame) -> np.ndarray:
    """The hashes (`key`, one row per chunk that names them) that most chunks name, ascending."""
    most = named.groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key").limit(LISTED).collect()
    return np.sort(np.array([row["key"] for row in most], np.int64).view(np.uint64))


def low_keys(hashes: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, int]:
    """The lowest of an ascending set that are not listed, and how many of them must be shared."""
    low = hashes[: np.searchsorted(hashes, LOWEST)]
    keys = np.setdiff1d(low, listed, assume_unique=True)
    return keys.view(np.int64), len(keys) - len(hashes) // KEYED


def parities(hashes: np.ndarray) -> bytes:
    """A bit per place. Places are a power of two, so that halves of more places fold into fewer."""
    places = min(PLACES, max(64, 1 << (4 * len(hashes) - 1).bit_length()))
    odd = np.bincount((hashes & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(one: pd.Series, other: pd.Series) -> np.ndarray:
    """In how many places parities differ, those of more places folded."""
    found = np.zeros(len(one), np.int32)
    sizes = np.array([(len(a), len(b)) for a, b in zip(one, other)], np.int64).reshape(-1, 2)
    for shape in np.unique(sizes, axis=0):
        same = np.flatnonzero((sizes == shape).all(axis=1))
        for rows in (same[at : at + STEP] for at in range(0, len(same), STEP)):
            sides = [np.frombuffer(b"".join(each.iloc[rows]), np.uint8).reshape(len(rows), -1) for each in (one, other)]
            for n in (0, 1):
                while sides[n].shape[1] > shape.min():
                    half = sides[n].shape[1] // 2
                    sides[n] = sides[n][:, :half] ^ sides[n][:, half:]
            found[rows] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1)
    return found


@F.pandas_udf(IntegerType())
def _differing(one: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series(differing(one, other))


def _sets(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """`num`, `node` and `group` of some texts, and their ascending sets; blank texts are left out."""
    for batch in batches:
        for at in range(0, len(batch), STEP):
            part = batch.iloc[at : at + STEP]
            sets = [np.unique(shingle_hashes(as_bytes(text), shingle)) for text in part["text"]]
            some = np.array([len(each) > 0 for each in sets], bool)
            yield part.loc[some, ["num", "node", "group"]], [each for each in sets if len(each)]


_LOWEST = "num long, node binary, group long, need int, keys array<long>"
_MARKED = "num long, node binary, group long, n int, bits binary, keys array<long>"


def lowest(texts: DataFrame, listed: np.ndarray, shingle: int) -> DataFrame:
    """Per text (`num`, `node`, `group`, `text`) the keys of the first step and how many must be shared."""
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, sets in _sets(batches, shingle):
            keys = [low_keys(each, listed) for each in sets]
            yield rows.assign(need=np.array([need for _, need in keys], np.int32), keys=[each for each, _ in keys])

    return texts.select("num", "node", "group", "text").mapInPandas(found, _LOWEST)


def marked(texts: DataFrame, shingle: int) -> DataFrame:
    """Per text (`num`, `node`, `group`, `text`) its number of hashes, parities and all hashes."""
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, sets in _sets(batches, shingle):
            yield rows.assign(
                n=np.array([len(each) for each in sets], np.int32),
                bits=[parities(each) for each in sets],
                keys=[each.view(np.int64) for each in sets],
            )

    return texts.select("num", "node", "group", "text").mapInPandas(found, _MARKED)


def covered(low: DataFrame) -> DataFrame:
    """The texts (`num`, `node`, `group`) that the first step leaves."""
    same = Window.partitionBy("key")
    keyed = low.select("num", "group", F.explode("keys").alias("key"))
    ends = keyed.select("num", F.min("group").over(same).alias("one"), F.max("group").over(same).alias("other"))
    shared = ends.filter("one < other").groupBy("num").agg(F.count(F.lit(1)).alias("shared"))
    return low.join(shared, "num", "left").filter("coalesce(shared, 0) >= need").select("num", "node", "group")


def prefixes(shared: DataFrame) -> DataFrame:
    """The keys of the third step and the rests of their sets, from the shared hashes (`key`) and in how many sets each is (`df`)."""
    mine = Window.partitionBy("num")
    rows = shared.withColumn("shared", F.count(F.lit(1)).over(mine)).withColumn("nth", F.row_number().over(mine.orderBy("df", "key")))
    # Hashes that are not shared come first.
    rows = rows.withColumn("at", (F.col("n") - F.col("shared") + F.col("nth") - 1).cast("int"))
    return rows.filter(f"at <= n div {KEYED}").select("key", "num", "group", "n", (F.col("n") - F.col("at")).alias("rest"))


def _lanes(count: str) -> Column:
    return F.ceil(F.col(count) / LANE).cast("int")


def _lane(count: str) -> Column:
    return F.pmod(F.xxhash64("num"), _lanes(count)).cast("int")


def _every(start: Column, count: str) -> Column:
    return F.explode(F.sequence(start, _lanes(count) - 1))


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of one key and cell whose groups differ and whose rests from the key on are long enough."""
    names = ("num", "group", "n", "rest")
    left, right = (side.select("key", "i", "j", *[F.col(name).alias(f"{name}_{tag}") for name in names]) for side, tag in ((left, "a"), (right, "b")))
    both = left.join(right, ["key", "i", "j"]).filter("group_a <> group_b AND 9 * least(rest_a, rest_b) >= 4 * (n_a + n_b)")
    return both.select(F.least("num_a", "num_b").alias("a"), F.greatest("num_a", "num_b").alias("b"))


def candidates(marks: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (`a`, `b`) of numbers in different groups that a key leaves open."""
    keyed = marks.select("num", "group", "n", F.explode("keys").alias("key"))
    ends = keyed.groupBy("key").agg(F.min("group").alias("one"), F.max("group").alias("other"), F.count(F.lit(1)).alias("df"))
    ends = scratch.save(ends.filter("one < other").select("key", "df"))
    shared = scratch.save(keyed.join(ends, "key"))
    firsts = scratch.save(prefixes(shared))
    for table in (ends, shared):
        scratch.drop(table)
    top = F.max(F.struct("members", "group")).alias("top")
    sizes = firsts.groupBy("key", "group").agg(F.count(F.lit(1)).alias("members")).groupBy("key").agg(top, F.sum("members").alias("all"))
    sizes = sizes.select("key", F.col("top.group").alias("main"), F.col("top.members").alias("mains"), (F.col("all") - F.col("top.members")).alias("others"))
    sizes = scratch.save(sizes.filter("others > 0"))
    rows = scratch.save(firsts.join(sizes, "key"))
    main = rows.filter("group = main").withColumn("i", _lane("mains")).withColumn("j", _every(F.lit(0), "others"))
    rest = rows.filter("group <> main").withColumn("lane", _lane("others"))
    beside = rest.withColumn("j", F.col("lane")).withColumn("i", _every(F.lit(0), "mains"))
    several = rest.filter("others > 1")
    left = several.withColumn("i", F.col("lane")).withColumn("j", _every(F.col("lane"), "others"))
    right = several.withColumn("j", F.col("lane")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lane"))))
    found = scratch.save(_met(main, beside).union(_met(left, right)).distinct())
    for table in (firsts, sizes, rows):
        scratch.drop(table)
    return found


def open_pairs(marks: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (`a`, `b`) of nodes in different groups that may be similar: all that are, and few others."""
    pairs = candidates(marks, scratch)
    left, right = (marks.select("num", "node", "n", "bits").toDF(tag, f"node_{tag}", f"n_{tag}", f"bits_{tag}") for tag in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.filter(F.col("n_a") + F.col("n_b") >= 9 * _differing("bits_a", "bits_b"))
    found = scratch.save(both.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    scratch.drop(pairs)
    return found
