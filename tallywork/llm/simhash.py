"""SimHash near-duplicates: fingerprints linked at 2 or fewer differing bits.

A fingerprint is cut into four blocks of 16 bits. Two that differ in at most two
bits agree in at least two blocks, so every pair of blocks is a join key of 32
bits. Candidates of a key are compared by the bits in which they differ. Only
distinct fingerprints take part; copies never meet each other.

A key that more than `BUCKET` distinct fingerprints share is not joined with
itself. Its fingerprints are linked by their neighbours instead: each names
itself and what one flipped bit outside the key's blocks makes of it. Two of
them name a common value exactly if at most two bits differ, so that nothing is
lost, rows grow with the fingerprints, and a value is named by 33 at most.

Null and blank texts have fingerprint zero, linked like any other. Rows with a
null doc_id take their component from the others of their group, or none.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallywork.llm.components import components
from tallywork.llm.scratch import Scratch
from tallywork.llm.wording import LOWER_BYTES, as_bytes

SEED, SHINGLE, BITS, BUCKET = 42, 3, 2, 16
BLOCK = 16
PAIRS = list(combinations(range(4), 2))
_CHUNK = 1 << 16


def shingle_hashes(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of `size` words, joined by one space; all words if they are fewer."""
    words = data.translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    return np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())), np.uint64, len(starts)
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bit n is set if it is in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        octets = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(shingle_hashes(as_bytes(text))) for text in texts], dtype="int64")


def _block(value: Column, block: int) -> Column:
    return F.shiftrightunsigned(value, block * BLOCK).bitwiseAND(F.lit(0xFFFF).cast("long"))


def _keys(value: Column) -> Column:
    """The values of each pair of blocks, with the number of the pair on top."""
    return F.array(*[
        F.lit(n << 2 * BLOCK).cast("long") + F.shiftleft(_block(value, one), BLOCK) + _block(value, other)
        for n, (one, other) in enumerate(PAIRS)
    ])


def _neighbours(value: Column, key: Column) -> Column:
    """The value, and it with each bit flipped that is outside the key's pair of blocks."""
    def flips(pair: tuple[int, int]) -> Column:
        bits = [bit for bit in range(64) if bit // BLOCK not in pair]
        masks = [0, *(1 << bit if bit < 63 else -(1 << 63) for bit in bits)]
        return F.array(*[F.lit(mask).cast("long") for mask in masks])

    pair = F.shiftrightunsigned(key, 2 * BLOCK)
    masks = F.coalesce(*[F.when(pair == n, flips(blocks)) for n, blocks in enumerate(PAIRS)])
    return F.transform(masks, lambda mask: value.bitwiseXOR(mask))


def links(prints: DataFrame, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """Links between distinct fingerprints (`print`): enough to join all that are close, directly or by way of others."""
    keyed = prints.select("print", F.explode(_keys(F.col("print"))).alias("key"))
    # Saved, here and below: a join of plain scans is one whose frequent keys Spark can split.
    sizes = scratch.save(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = scratch.save(keyed.join(sizes, "key"))
    few = shared.filter(F.col("n") <= bucket)
    left, right = few.select("key", F.col("print").alias("a")), few.select("key", F.col("print").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
    pairs = left.join(right, "key").filter((F.col("a") < F.col("b")) & close).select("a", "b")
    many = shared.filter(F.col("n") > bucket)
    named = many.select("print", F.explode(_neighbours(F.col("print"), F.col("key"))).alias("value"))
    groups = named.groupBy("value").agg(F.collect_set("print").alias("prints")).filter(F.size("prints") > 1)
    stars = groups.select(F.array_min("prints").alias("a"), F.explode("prints").alias("b")).filter("a <> b")
    return pairs.union(stars).distinct()


def groups(docs: DataFrame, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, `_hash` of its text, `print`, and `component_id`."""
    rows = scratch.save(docs.select("doc_id", F.xxhash64("text").alias("_hash"), fingerprints("text").alias("print")))
    prints = scratch.save(rows.groupBy("print").agg(F.min("doc_id").alias("rep")))
    found = components(links(prints.select("print"), scratch, bucket), scratch)
    linked = prints.join(found, prints["print"] == found["node"]).select("print", "rep", "least")
    whole = scratch.save(linked.groupBy("least").agg(F.min("rep").alias("component_id")))
    named = linked.join(whole, "least").select("print", "component_id")
    named = prints.join(named, "print", "left").select(
        "print", F.coalesce("component_id", "rep").alias("component_id")
    )
    return rows.join(scratch.save(named), "print").select("doc_id", "_hash", "print", "component_id")


def one_of_each(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents, with one of each group: that of the least doc_id, null ids last."""
    found = groups(docs, scratch)
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("print "), F.hex("print")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash")
    kept = found.groupBy(group.alias("group")).agg(F.min(order).alias("first")).select("first.*")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_kept")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("_hash"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_kept"))
    rows = rows.join(kept, same, "left_semi").withColumn("_id", F.col("_row.doc_id"))
    return rows.dropDuplicates(["_id", "_hash"]).select("_row.*")


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
