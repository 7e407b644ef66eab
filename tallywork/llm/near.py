"""Near copies: one document of each group that close fingerprints or similar word sets connect.

Two documents are linked if the SimHash fingerprints of their shingles of five
words differ in two bits at most, or if the sets of those shingles have a Jaccard
similarity of 0.8 or more. Close fingerprints are found by pigeonhole blocks (see
`simhash`). At 0.8 fingerprints differ in some ten bits, which no blocks of 64
bits can find, so similar sets have candidates of their own:

1. A text has 64 least hashes under 64 multipliers, and 16 band keys of four of
   them. Two sets of similarity 0.8 miss each other in all bands with a
   probability of 0.0002.
2. The texts of a band are compared with one of them, its hub: the text that has
   most band mates in all. Copies of one text with edits of their own are less
   like each other than like that text, which so is the hub. A pair is compared
   by the 64 hashes first, which lets through 0.8 unless they are 3.5 standard
   deviations off, and then by the whole sets.
3. Texts that differ from their hub stay in the band and choose a new hub,
   `ROUNDS` times in all. A text has `ROUNDS` comparisons in each of its bands, so
   rows grow with the texts, however large a group is or how many share a passage.

4. The bands miss a few pairs and the rounds leave some uncompared. So all pairs
   that are not in one group by then are searched by covered sets and prefixes,
   which miss none (see `prefixes`). The bands bring large groups together at little cost; the
   result does not depend on what they find.

Pairs carry no texts: for the whole comparison the members of a hub are dealt to
lanes, each with one copy of the hub's text. Texts stand for themselves by 128
bits, so equal texts are one node. Null and blank texts have fingerprint zero and
are linked with each other only. Rows with a null doc_id come last in a group, and
of rows equal in doc_id and text one stays. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tallywork.llm import prefixes, simhash
from tallywork.llm.components import components
from tallywork.llm.prefixes import CHUNK, frequent
from tallywork.llm.scratch import Scratch
from tallywork.llm.simhash import fingerprint, shingle_hashes
from tallywork.llm.wording import as_bytes, mixed

# Five words, and similarity 4/5.
SHINGLE, PART, WHOLE = 5, 4, 5
BANDS, ROWS = 16, 4
ROUNDS = 3
LOOK = 40  # of the 64 least hashes so many are equal, or the pair is not looked at any more: 0.625, where 0.8 +- 0.05 is due
LANE = 200  # members of a hub that one lane compares
_CHUNK = 2048
_ODDS = (mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1))[None, :]


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct hashes in order."""
    return np.unique(shingle_hashes(as_bytes(text), size))


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least of all hashes under each multiplier."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        np.minimum(least, (hashes[at : at + _CHUNK, None] * _ODDS).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each band and its least hashes."""
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + mixed(column))
    return key.view(np.int64)


def node(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


_SIGNED = "doc_id long, node binary, print long, n int, sig binary, keys array<long>, often array<long>"


def signed(docs: DataFrame) -> DataFrame:
    """Per row the text's node, fingerprint, number of shingles, least hashes (their upper halves) and band keys.

    `often` names the frequent shingles of the chunk of rows that ends with the row.
    """
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints, sizes, sigs, keys, often, chunk, held = [], [], [], [], [], [], 0
            for at, text in enumerate(batch["text"], 1):
                hashes = shingle_hashes(as_bytes(text), SHINGLE)
                least = least_hashes(hashes)
                prints.append(fingerprint(hashes))
                chunk.append(np.unique(hashes))
                sizes.append(len(chunk[-1]))
                held += sizes[-1]
                ends = held >= CHUNK or at == len(batch)
                often.append(frequent(chunk) if ends else [])
                chunk, held = ([], 0) if ends else (chunk, held)
                sigs.append((least >> np.uint64(32)).astype("<u4").tobytes())
                keys.append(band_keys(least) if len(hashes) else [])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "node": batch["node"], "print": prints, "n": np.array(sizes, np.int32), "sig": sigs, "keys": keys, "often": often})

    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), node(text).alias("node"), text.alias("text")).mapInPandas(found, _SIGNED)


@F.pandas_udf(IntegerType())
def _agreeing(one: pd.Series, other: pd.Series) -> pd.Series:
    left, right = (np.frombuffer(b"".join(each), "<u4").reshape(-1, BANDS * ROWS) for each in (one, other))
    return pd.Series((left == right).sum(axis=1).astype(np.int32))


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (`a`, `b`) that sizes and least hashes leave open."""
    left, right = (sketches.toDF(name, f"n_{name}", f"sig_{name}") for name in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b").filter(PART * F.greatest("n_a", "n_b") <= WHOLE * F.least("n_a", "n_b"))
    return both.filter(_agreeing("sig_a", "sig_b") >= LOOK).select("a", "b")


def _similar(pairs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (`a`, `b`) whose whole sets are similar."""
    lanes = F.ceil(F.count(F.lit(1)) / LANE).cast("int").alias("lanes")
    hubs = scratch.save(pairs.groupBy("a").agg(lanes))
    lane = F.pmod(F.xxhash64("b"), F.col("lanes")).cast("int").alias("lane")
    named = texts.withColumnRenamed("node", "b")
    dealt = scratch.save(pairs.join(hubs, "a").select("a", lane, "b"))
    members = dealt.join(named, "b").select("a", "lane", "b", "text")
    copies = hubs.select("a", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane")).join(texts.withColumnRenamed("node", "a"), "a")
    rows = copies.select("a", "lane", F.lit(None).cast("binary").alias("b"), "text").unionByName(members)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub: np.ndarray | None = None
        for batch in batches:
            same = []
            for other, text in zip(batch["b"], batch["text"]):
                one = shingle_set(text)
                if other is None:
                    hub = one
                    same.append(False)
                    continue
                shared = len(np.intersect1d(one, hub, assume_unique=True))
                same.append(WHOLE * shared >= PART * (len(one) + len(hub) - shared))
            yield batch.loc[same, ["a", "b"]]

    rows = rows.repartition("a", "lane").sortWithinPartitions("a", "lane", F.col("b").asc_nulls_first())
    found = scratch.save(rows.select("a", "b", "text").mapInPandas(compared, "a binary, b binary"))
    for table in (hubs, dealt):
        scratch.drop(table)
    return found


def _close_prints(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (`a`, `b`) between nodes of equal or close fingerprints."""
    firsts = scratch.save(rows.groupBy("print").agg(F.min("node").alias("a")))
    equal = rows.select("print", F.col("node").alias("b")).join(firsts, "print").filter("a <> b").select("a", "b")
    close = scratch.save(simhash.links(firsts.select("print"), scratch)).toDF("one", "other")
    close = close.join(firsts.toDF("one", "a"), "one").join(firsts.toDF("other", "b"), "other").select("a", "b")
    return scratch.save(equal.union(close).distinct())


def _with_degrees(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """The bands that two texts share (`key`, `node`), and in `degree` how many rows the bands of a node have."""
    sizes = scratch.save(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = scratch.save(keyed.join(sizes, "key"))
    degrees = scratch.save(shared.groupBy("node").agg(F.sum("n").alias("degree")))
    found = scratch.save(shared.select("key", "node").join(degrees, "node"))
    for table in (sizes, shared, degrees):
        scratch.drop(table)
    return found


def _round(shared: DataFrame, texts: DataFrame, sketches: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Links of every band's texts with its hub, and the rows of those that differ from it."""
    hub = F.max_by("node", F.struct("degree", "node")).alias("hub")
    hubs = scratch.save(shared.groupBy("key").agg(hub, F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    rows = scratch.save(shared.join(hubs, "key").filter("node <> hub"))
    pairs = scratch.save(rows.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    likely = scratch.save(_likely(pairs, sketches))
    found = _similar(likely, texts, scratch)
    linked = found.toDF("hub", "node")
    left = scratch.save(rows.join(linked, ["hub", "node"], "left_anti").select("key", "node", "degree"))
    for table in (hubs, rows, pairs, likely):
        scratch.drop(table)
    return found, left


def _between_groups(every: DataFrame, rows: DataFrame, whole: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (`a`, `b`) between all similar texts that are not in one group of `whole`."""
    listed = prefixes.listed_hashes(rows.select(F.explode("often").alias("key")))
    named = scratch.save(whole.select("least").distinct().withColumn("group", F.monotonically_increasing_id()))
    grouped = scratch.save(whole.join(named, "least").select("node", "group"))
    texts = every.dropDuplicates(["node"]).join(grouped.hint("merge"), "node", "left").withColumn("num", F.monotonically_increasing_id())
    # A text without a group is one of its own, with a number below zero.
    texts = texts.withColumn("group", F.coalesce("group", -1 - F.col("num")))
    low = scratch.save(prefixes.lowest(texts, listed, SHINGLE))
    left = scratch.save(prefixes.covered(low))
    for table in (named, grouped, low):
        scratch.drop(table)
    texts = every.join(left.hint("merge"), "node").dropDuplicates(["node"])
    marks = scratch.save(prefixes.marked(texts, SHINGLE))
    pairs = prefixes.open_pairs(marks, scratch)
    for table in (left, marks):
        scratch.drop(table)
    mates = scratch.save(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    texts = scratch.save(every.join(mates.hint("merge"), "node", "left_semi").dropDuplicates(["node"]))
    found = _similar(pairs, texts, scratch)
    for table in (pairs, mates, texts):
        scratch.drop(table)
    return found


def groups(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """`doc_id`, `node` and `least`, the least node of its group, for every row."""
    rows = scratch.save(signed(docs))
    links = _close_prints(rows, scratch)
    signs = scratch.save(rows.filter("n > 0").select("node", "n", "sig", "keys").dropDuplicates(["node"]))
    shared = _with_degrees(signs.select("node", F.explode("keys").alias("key")), scratch)
    sketches = signs.drop("keys")
    every = docs.filter("text IS NOT NULL").select(node(F.col("text")).alias("node"), "text")
    # Here and at the end texts are sorted by node at every size: no list of nodes is broadcast.
    mates = shared.select("node").distinct().hint("merge")
    texts = scratch.save(every.join(mates, "node", "left_semi").dropDuplicates(["node"]))
    for _ in range(ROUNDS):
        before = shared
        found, shared = _round(before, texts, sketches, scratch)
        scratch.drop(before)
        links = links.union(found)
    for table in (texts, signs, shared):
        scratch.drop(table)
    whole = scratch.save(components(links, scratch))
    missed = _between_groups(every, rows, whole, scratch)
    for name in ("a", "b"):
        missed = missed.join(whole.toDF(name, f"least_{name}"), name, "left").withColumn(name, F.coalesce(f"least_{name}", name)).drop(f"least_{name}")
    joined = scratch.save(components(missed, scratch).toDF("least", "joined"))
    found = rows.select("doc_id", "node").join(whole, "node", "left").withColumn("least", F.coalesce("least", "node"))
    return found.join(joined, "least", "left").select("doc_id", "node", F.coalesce("joined", "least").alias("least"))


def one_of_each(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents, with one of each group and of each text: that of the least doc_id, null ids last."""
    inner = Scratch(scratch.spark)
    found = scratch.save(groups(docs, inner))
    inner.close()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    first = found.groupBy("least").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = scratch.save(first.select("least", F.col("first.doc_id").alias("_first"), F.col("first.node").alias("_kept")))
    mine = F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("node") == F.col("_kept"))
    marked = found.join(first, "least").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"), mine.alias("_mine"))
    gone = scratch.save(marked.filter("NOT _mine").select("_id", "_node").distinct())
    twice = marked.filter("_mine").groupBy("_id", "_node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = docs.select(F.struct("*").alias("_row")).withColumn("_text", node(F.coalesce(F.col("_row.text"), F.lit(""))))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_node"))
    rows = rows.join(gone.hint("merge"), same, "left_anti")
    twice = scratch.save(twice)
    if twice.head(1):  # rows equal in doc_id and text: a few, which alone are brought together
        again = rows.join(twice, same, "left_semi").withColumn("_id", F.col("_row.doc_id")).dropDuplicates(["_id", "_text"]).drop("_id")
        rows = rows.join(twice, same, "left_anti").unionByName(again)
    return rows.select("_row.*")
