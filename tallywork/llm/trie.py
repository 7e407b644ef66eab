"""Prefix trie of conversations: a node for every distinct sequence of first turns, with subtree figures.

A conversation is a path: the 128-bit digests of its turns, one after the other,
so that paths in byte order are a trie in order. Paths are dealt to shards by
ranges of (path, conv_id), which splits even a sequence that a third of all
conversations share. The paths at which shards begin, the splitters, form a
skeleton: a node lies in two shards only if it is on a splitter's path. The
skeleton is broadcast, after its size has been measured. A shard is read in
order with one stack, finishes all nodes that are not in the skeleton, and gives
partial sums for those that are; the partial sums are reduced to totals per
skeleton node, and a fold over the skeleton alone adds up its subtrees.

The ids of the conversations that end at a skeleton node are joined in pieces by
the shards; the digest over them reads those pieces in order, never all at once.

Turns are ordered by `turn`, null first, equal ones by their digest. Null roles
and texts are empty. Repeated rows are turns of their own. Rows without a conv_id
belong to no conversation and are left out. No conversation, no node. The digests
and word counts of one conversation, 40 bytes a turn, are held by one task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.scratch import Scratch

DIGEST = 16
SKELETON_BYTES = 64 << 20  # of splitter paths; more make fewer shards
PIECE = 4096  # ids in one piece of a skeleton node's list
ROWS = 20_000  # nodes in an output batch
SHARE, FORKS = 20, 4  # of the given table: conversations of a family, and turns taken over from its first

_OUT = (
    "kind int, skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, words long, shard int, piece int, ids string"
)
_KINDS = [tuple(part.split()) for part in _OUT.split(", ")]
NODE, PART, ENDS = 0, 1, 2
_EMPTY = hashlib.sha256().hexdigest()


def turns(rows: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, and of each turn the digest (hex) and the number of words."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return rows.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), words.alias("words"))


def _paths(items: Column) -> list[Column]:
    return [
        F.unhex(F.array_join(F.transform(items, lambda each: each["digest"]), "")).alias("path"),
        F.transform(items, lambda each: each["words"]).alias("words"),
    ]


def _in_order() -> Column:
    return F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "digest", "words")))


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: `conv_id`, `path`, and `words` of each turn."""
    return turns(rows).groupBy("conv_id").agg(_in_order().alias("items")).select("conv_id", *_paths(F.col("items")))


def rebuilt(rows: DataFrame, share: int = SHARE, forks: int = FORKS) -> DataFrame:
    """As `conversations`, where each of a family of `share` ids begins with first turns of the family's first id.

    A conversation takes as many as the CRC-32 of its id gives modulo `forks`;
    its own first ones are left out instead.
    """
    family = (F.col("conv_id") - F.col("conv_id") % share).alias("family")
    dealt = turns(rows).select(family, "*").repartition("family")
    whole = dealt.groupBy("family", "conv_id").agg(_in_order().alias("items"))
    first = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("items", 1, forks - 1))).over(Window.partitionBy("family"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % forks).cast("int")
    whole = whole.select("conv_id", "items", F.coalesce(first, F.slice("items", 1, 0)).alias("first"), taken.alias("taken"))
    own = F.slice("items", F.col("taken") + 1, F.greatest(F.size("items"), F.lit(1)))
    return whole.select("conv_id", F.concat(F.slice("first", F.lit(1), F.col("taken")), own).alias("items")).select("conv_id", *_paths(F.col("items")))


def splitters(paths: DataFrame, shards: int, most: int = SKELETON_BYTES) -> list[tuple[bytes, int]]:
    """The first (path, conv_id) of each shard but the first; fewer shards if they would take more than `most` bytes."""
    key = F.struct("path", "conv_id")
    while True:
        dealt = paths.select(key.alias("key")).repartitionByRange(shards, "key")
        firsts = dealt.groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).select("key.*")
        # One row per shard: the paths come to the driver only if all of them fit.
        fits = F.sum(F.octet_length("path")).over(Window.partitionBy()) <= most
        found = firsts.select(F.when(fits, F.col("path")).alias("path"), "conv_id").collect()
        if not found or found[0]["path"] is not None:
            return sorted((bytes(row["path"]), row["conv_id"]) for row in found)[1:]
        shards //= 2
        if shards < 2:
            return []


class Skeleton:
    """The trie of the splitter paths. Node 0 is the root; `child` goes from a node and a digest to a node."""

    def __init__(self, marks: list[tuple[bytes, int]]):
        self.marks, self.child, self.parent = marks, {}, [-1]
        for path, _ in marks:
            at = 0
            for place in range(0, len(path), DIGEST):
                step = (at, path[place : place + DIGEST])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(at)
                at = self.child[step]


class _Node:
    __slots__ = ("skeleton", "words", "first", "convs", "children", "leaves", "saved", "ends", "piece", "waiting")

    def __init__(self, skeleton: int, words: int):
        self.skeleton, self.words, self.first, self.convs = skeleton, words, None, 0
        self.children = self.leaves = self.saved = 0
        self.ends, self.piece = [], 0
        self.waiting: list[list] = []  # finished children: they need this node's least conv_id


class _Shard:
    """Reads the paths of one shard in order; finished rows gather in `out`."""

    def __init__(self, shard: int, skeleton: Skeleton, out: list[tuple]):
        self.shard, self.skeleton, self.out = shard, skeleton, out
        self.path, self.stack = b"", [_Node(0, 0)]

    def add(self, conv_id: int, path: bytes, words: np.ndarray) -> None:
        stack, before = self.stack, self.path
        same, at = min(len(path), len(before)), 0
        while at < same and path[at : at + DIGEST] == before[at : at + DIGEST]:
            at += DIGEST
        self.close(at // DIGEST)
        for depth in range(at // DIGEST, len(path) // DIGEST):
            above = stack[-1].skeleton
            number = -1 if above < 0 else self.skeleton.child.get((above, path[depth * DIGEST : (depth + 1) * DIGEST]), -1)
            stack.append(_Node(number, int(words[depth])))
        last = stack[-1]
        last.convs += 1
        if last.first is None or conv_id < last.first:
            last.first = conv_id
        last.ends.append(str(conv_id))
        if last.skeleton >= 0 and len(last.ends) == PIECE:
            self.flush(last)
        self.path = path

    def flush(self, node: _Node) -> None:
        if node.ends:
            self.out.append([ENDS, node.skeleton, *[None] * 9, self.shard, node.piece, ",".join(node.ends)])
            node.ends, node.piece = [], node.piece + 1

    def close(self, depth: int) -> None:
        """Finish the open nodes that are deeper than `depth`."""
        stack = self.stack
        while len(stack) > depth + 1:
            self.finish(stack.pop(), stack[-1], len(stack))

    def finish(self, node: _Node, above: _Node | None, depth: int) -> None:
        if above is not None:
            above.convs += node.convs
            if above.first is None or node.first < above.first:
                above.first = node.first
        if node.skeleton >= 0:
            self.flush(node)
            for row in node.waiting:  # the least conv_id of a skeleton node is known after the reduction
                row[1] = node.skeleton
                self.out.append(row)
            self.out.append([PART, node.skeleton, node.first, depth, None, node.convs, node.children, node.leaves, node.saved,
                             None, node.words, self.shard, None, None])
            return
        for row in node.waiting:
            row[4] = node.first
            self.out.append(row)
        leaves, saved = node.leaves or 1, node.saved + (node.convs - 1) * node.words
        ends = hashlib.sha256(",".join(node.ends).encode()).hexdigest() if node.ends else _EMPTY
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        row = [NODE, -1, node.first, depth, None, node.convs, node.children, leaves, saved, ends, None, None, None, None]
        above.waiting.append(row)
        if above.skeleton >= 0 and len(above.waiting) >= PIECE:
            for row in above.waiting:
                row[1] = above.skeleton
            self.out += above.waiting
            above.waiting = []

    def end(self) -> None:
        self.close(0)
        self.finish(self.stack.pop(), None, 0)


def _scan(batches: Iterator[pd.DataFrame], skeleton: Skeleton) -> Iterator[pd.DataFrame]:
    out: list[list] = []
    at: _Shard | None = None
    for batch in batches:
        for shard, conv_id, path, words in zip(batch["shard"].tolist(), batch["conv_id"].tolist(), batch["path"].tolist(), batch["words"].tolist()):
            if at is None or shard != at.shard:
                if at is not None:
                    at.end()
                at = _Shard(shard, skeleton, out)
            at.add(conv_id, bytes(path), words)
            if len(out) >= ROWS:
                yield _frame(out)
                out.clear()
    if at is not None:
        at.end()
    if out:
        yield _frame(out)


def _frame(out: list[list]) -> pd.DataFrame:
    kinds = {"int": "Int32", "long": "Int64", "string": object}
    return pd.DataFrame({name: pd.Series(values, dtype=kinds[kind]) for (name, kind), values in zip(_KINDS, zip(*out))})


def _digests(pieces: DataFrame) -> DataFrame:
    """`skeleton`, `ends_sha256`: the digest of each node's ids, read piece by piece in order."""
    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, digest, done = None, None, []
        for batch in batches:
            for skeleton, ids in zip(batch["skeleton"].tolist(), batch["ids"].tolist()):
                if skeleton != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = skeleton, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if node is not None:
            done.append((node, digest.hexdigest()))
        yield pd.DataFrame(done, columns=["skeleton", "ends_sha256"])

    dealt = pieces.select("skeleton", "shard", "piece", "ids").repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece")
    return dealt.select("skeleton", "ids").mapInPandas(streamed, "skeleton int, ends_sha256 string")


def _reduced(found: DataFrame, skeleton: Skeleton) -> pd.DataFrame:
    """The rows of the skeleton's nodes: sums per node over the shards, then one fold over the skeleton."""
    sums = found.filter(F.col("kind") == PART).groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("words").alias("words"),
    ).join(_digests(found.filter(F.col("kind") == ENDS)), "skeleton", "left").toPandas().set_index("skeleton").sort_index()
    rows = {key: row for key, row in zip(sums.index.tolist(), sums.to_dict("records"))}
    for number in sorted(rows, reverse=True):  # a node has a greater number than its parent
        row, above = rows[number], rows.get(skeleton.parent[number])
        row["saved_tokens"] += (row["n_convs"] - 1) * row.pop("words")
        row["n_leaves"] = row["n_leaves"] or 1
        if above is not None:
            above["n_children"] += 1
            above["n_leaves"] += row["n_leaves"]
            above["saved_tokens"] += row["saved_tokens"]
        row["parent_conv_id"] = above["conv_id"] if above is not None else None
        row["skeleton"] = number
        row["ends_sha256"] = row["ends_sha256"] if isinstance(row["ends_sha256"], str) else _EMPTY
    return list(rows.values())


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(paths: DataFrame, scratch: Scratch, shards: int | None = None, most: int = SKELETON_BYTES) -> DataFrame:
    """One row per node of the trie of `paths` (`conv_id`, `path`, `words`).

    `conv_id` is the least conversation that goes through the node,
    `parent_conv_id` the parent's. `saved_tokens` is what the subtree's words
    shrink by if shared turns are stored once.
    """
    spark = scratch.spark
    paths = scratch.save(paths)
    skeleton = Skeleton(splitters(paths, shards or int(spark.conf.get("spark.sql.shuffle.partitions")), most))
    sent = spark.sparkContext.broadcast(skeleton)

    @F.pandas_udf("int")
    def shard(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        marks = sent.value.marks
        return pd.Series([bisect_right(marks, (bytes(each), number)) for each, number in zip(path, conv_id.tolist())], dtype="int32")

    dealt = paths.select(shard("path", "conv_id").alias("shard"), "conv_id", "path", "words")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    found = scratch.save(dealt.mapInPandas(lambda batches: _scan(batches, sent.value), _OUT))
    rows = _reduced(found, skeleton)
    order = ("skeleton", *COLUMNS)
    kind = "skeleton int, " + ", ".join(f"{name} {'string' if name == 'ends_sha256' else 'long'}" for name in COLUMNS)
    top = spark.createDataFrame([tuple(row[name] for name in order) for row in rows], kind)
    least = F.broadcast(top.select("skeleton", F.col("conv_id").alias("_least")))  # as many rows as the skeleton has nodes
    local = found.filter(F.col("kind") == NODE).join(least, "skeleton", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_least"))
    return local.select(*COLUMNS).union(top.select(*COLUMNS))
