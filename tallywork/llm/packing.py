"""Conflict-constrained best-fit packing of documents into sequences of fixed capacity.

A document has a length in tokens. What does not fit a sequence of its own is
cut: full sequences go out as they are, the rest is packed. Two pieces may not
share a bin if they are from the same source or from the same duplicate cluster
(pieces with no source, or no cluster, conflict with none by it).

Pieces are dealt to shards of about `SHARD` by a hash of their identity, so that
a hot source or cluster is spread evenly over all shards. Within a shard they
come longest first. Open bins are ordered by what is left in them; each carries
its sources and clusters as bitmaps. From the first bin in which the piece fits,
successors are tried until one has no conflict: the tightest compatible bin. If
there is none, a new bin opens. A task holds one shard at a time; rows that are
equal in everything meet in one shard, which is packed in parts if they make it
longer than four times `SHARD`.

Null texts have length 1, for the end of the document. Rows with the same doc_id
are packed one by one. `bin_id` is made of the shard and the number of the bin
in it; it does not depend on partitions.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.scratch import Scratch
from tallywork.llm.wording import words

CAPACITY, SHARD = 2048, 4096
BINS = 1 << 32  # bin numbers of a shard are below this
# Long numbers go through pandas as text: beside a null they would become floating-point numbers there.
_PACKED = "bin_id long, doc_id string, piece int, tokens int, source string, cluster string"


def lengths(docs: DataFrame) -> DataFrame:
    """Number of words and one end per document; the cluster is the hash of the words in lower case."""
    found = words(F.lower("text"))
    return docs.select(
        "doc_id", "source", (F.size(found) + 1).cast("long").alias("tokens"),
        F.when(F.size(found) > 0, F.xxhash64(F.array_join(found, " "))).alias("cluster"),
    )


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per full sequence of a long document and one for its rest."""
    count = F.ceil(F.col("tokens") / capacity).cast("int")
    cut = docs.select("doc_id", "source", "cluster", "tokens", F.explode(F.sequence(F.lit(1), count)).alias("piece"))
    size = F.least(F.lit(capacity).cast("long"), F.col("tokens") - (F.col("piece") - 1) * capacity)
    return cut.select("doc_id", "piece", size.cast("int").alias("tokens"), "source", "cluster")


def best_fit(rows: list[tuple[int, int, int]], capacity: int = CAPACITY) -> list[int]:
    """The bin of each (length, source bit, cluster bit), taken in the given order. Bit 0 conflicts with nothing."""
    left: list[tuple[int, int]] = []  # (room, bin), ordered: the order in which bins are tried
    sources: list[int] = []
    clusters: list[int] = []
    found = []
    for length, source, cluster in rows:
        at = bisect_left(left, (length, -1))
        while at < len(left) and (sources[left[at][1]] & source or clusters[left[at][1]] & cluster):
            at += 1
        if at < len(left):
            room, chosen = left.pop(at)
        else:
            room, chosen = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[chosen] |= source
        clusters[chosen] |= cluster
        if room > length:
            insort(left, (room - length, chosen))
        found.append(chosen)
    return found


def _bits(values: list) -> list[int]:
    """One bit per distinct value that occurs twice or more; 0 for the others and for nulls."""
    places: dict = {}
    count: dict = {}
    for value in values:
        count[value] = count.get(value, 0) + 1
    for value, n in count.items():
        if n > 1 and not pd.isna(value):
            places[value] = 1 << len(places)
    return [places.get(value, 0) for value in values]


def pack_shard(shard: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    """Pack the rows of one shard; adds `bin`."""
    shard = shard.sort_values(
        ["tokens", "doc_id", "piece", "source", "cluster"], ascending=[False, True, True, True, True], kind="stable"
    ).reset_index(drop=True)
    bits = zip(shard["tokens"].tolist(), _bits(shard["source"].tolist()), _bits(shard["cluster"].tolist()))
    return shard.assign(bin=best_fit(list(bits), capacity))


def pack(docs: DataFrame, scratch: Scratch, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """`docs` has doc_id, source, tokens and cluster. One row per piece with its `bin_id`."""
    cut = scratch.save(pieces(docs, capacity))
    count = max(1, -(-cut.count() // shard))
    dealt = cut.withColumn("_shard", F.pmod(F.xxhash64(*cut.columns), F.lit(count)))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = done = 0

        def out() -> pd.DataFrame:
            rows = pack_shard(pd.concat(held, ignore_index=True), capacity)
            rows["bin_id"] = rows["_shard"].astype("int64") * BINS + done + rows["bin"]
            return rows[["bin_id", "doc_id", "piece", "tokens", "source", "cluster"]]

        for batch in batches:
            for number, rows in batch.groupby("_shard", sort=True):
                other = bool(held) and held[0]["_shard"].iloc[0] != number
                if other or size >= 4 * shard:
                    packed_rows = out()
                    yield packed_rows
                    done = 0 if other else int(packed_rows["bin_id"].max()) % BINS + 1
                    held, size = [], 0
                held.append(rows)
                size += len(rows)
        if held:
            yield out()

    as_text = {name: F.col(name).cast("string") for name in ("doc_id", "cluster")}
    order = ["_shard", "doc_id", "piece", "tokens", "source", "cluster"]
    rows = dealt.withColumns(as_text).repartition("_shard").sortWithinPartitions(*order).mapInPandas(packed, _PACKED)
    return rows.withColumns({name: F.col(name).cast("long") for name in as_text})
