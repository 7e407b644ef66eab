"""Substring dedup: word windows that an earlier document holds are taken out.

Windows of `WINDOW` words begin the suffixes of a document. The suffixes are
split into groups that a task can hold, by a prefix of varying length:

0. Of documents with one text only the first goes on: all windows of the others
   start in it.
1. Every window has an anchor: the run of `ANCHOR` words in it whose hash is
   least. Equal windows have equal anchors. Neighbouring windows mostly share
   one, so that a document gives few runs of windows, and only those whose
   anchor is found in two documents go on. Runs with the same words are one: the
   least doc_id stands for them, and all windows of the others are repeats.
2. The anchor is the prefix of a group. While a group has more than `GROUP`
   windows, its runs are cut by the place of the anchor in the window, and the
   prefix grows to all the words that windows of one cut have in common, in
   steps until it is the whole window; pieces with the same words are one again.
   A group whose prefix is the whole window has one member.
3. The suffixes of a group are sorted: a suffix tree in order. Neighbours that
   share `WINDOW` words or more lie below one deep inner node; the common depth
   of its leaves is the length of a repeat, and the least doc_id among them
   decides who keeps it. Suffixes inside a longer repeat are dropped, so that
   what remains are repeats that cannot be extended within the run.

A run stands for itself by a digest of 128 bits of its words, and in step 3 words
are compared. Prefix hashes only choose groups.

Null texts have no words. A null doc_id is greater than any other. Rows with
equal doc_id are neither smaller than the other: they do not take from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallywork.llm.scratch import Scratch
from tallywork.llm.wording import as_bytes, sliding_min, span_hashes, window_hashes, word_spans

WINDOW, ANCHOR = 50, 8
GROUP = 100_000  # windows of a subtree, some 500 bytes each while it is sorted
RUN = 256  # windows of a run at most
STEP = 4  # a longer prefix is for a fourth of the places of the anchor
LAST = (1 << 63) - 1  # the order of a null doc_id
ALL = -1  # instead of a number of windows: all of them

_RUNS = "doc long, _hash long, anchor long, start int, n int, digest binary"
_PARTS = "owner binary, at int, key long, doc long, digest binary, n int, words binary"
_FOUND = "digest binary, k int, length int"


def _rank(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(_rank(F.col("doc_id")).alias("doc"), F.xxhash64(text).alias("_hash"), F.col(text).alias("text"))


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _line(text: str | None) -> bytes:
    """The words of a text, one blank between."""
    return b" ".join(as_bytes(text).split())


def _digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def anchor_runs(line: bytes, window: int = WINDOW, anchor: int = ANCHOR) -> list[tuple[int, int, int, bytes]]:
    """Runs of neighbouring windows with one anchor: the anchor, the first window, how many windows, a digest."""
    starts, ends = word_spans(line)
    if len(starts) < window:
        return []
    least = sliding_min(window_hashes(span_hashes(line, starts, ends), anchor), window - anchor + 1)
    edges = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    sizes = np.diff(np.append(edges, len(least)))
    if (sizes > RUN).any():
        edges = np.concatenate([np.arange(at, at + size, RUN) for at, size in zip(edges, sizes)])
        sizes = np.minimum(np.diff(np.append(edges, len(least))), RUN)
    bounds = zip(starts[edges].tolist(), ends[edges + sizes + window - 2].tolist())
    digests = [_digest(line[a:b]) for a, b in bounds]
    return list(zip(least[edges].view(np.int64).tolist(), edges.tolist(), sizes.tolist(), digests))


def runs(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The anchor runs of keyed documents."""
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (doc, mark, *run)
                for doc, mark, text in zip(batch["doc"], batch["_hash"], batch["text"])
                for run in anchor_runs(_line(text), window, anchor)
            ]
            if rows:
                yield pd.DataFrame(rows, columns=_names(_RUNS))

    return docs.mapInPandas(found, _RUNS)


def _with_words(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The wanted runs with their words."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text, wanted in zip(batch["doc"], batch["text"], batch["wanted"]):
                line = _line(text)
                starts, ends = word_spans(line)
                for run in wanted:
                    first, n = run["start"], run["n"]
                    words = line[starts[first] : ends[first + n + window - 2]]
                    rows.append((run["anchor"], doc, run["digest"], n, words))
                if len(rows) > 5000:
                    yield pd.DataFrame(rows, columns=_names(kind))
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=_names(kind))

    kind = "key long, doc long, digest binary, n int, words binary"
    per_doc = wanted.groupBy("doc", "_hash").agg(F.collect_list(F.struct("start", "n", "anchor", "digest")).alias("wanted"))
    joined = docs.join(per_doc, ["doc", "_hash"]).dropDuplicates(["doc", "_hash"])
    return joined.select("doc", "text", "wanted").mapInPandas(cut, kind)


def lengthened(words: bytes, width: int, window: int = WINDOW, anchor: int = ANCHOR) -> list[tuple[int, int, int, bytes]]:
    """A run cut by the place of the anchor: the first window, how many, a hash of the longer prefix, and the words.

    A cut is for `width` places, and its prefix is the words that all windows
    with the anchor there have in common.
    """
    starts, ends = word_spans(words)
    grams = window_hashes(span_hashes(words, starts, ends), anchor)
    places = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1).argmin(axis=1)
    at, cuts = np.arange(len(places)) + places, places // width
    edges = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (cuts[1:] != cuts[:-1]))))
    found = []
    for first, end in zip(edges.tolist(), np.append(edges[1:], len(places)).tolist()):
        low = int(cuts[first]) * width
        high = min(low + width, window - anchor + 1) - 1
        prefix = words[starts[at[first] - low] : ends[at[first] + window - 1 - high]]
        key = hashlib.blake2b(b"%d %d " % (width, low) + prefix, digest_size=8).digest()
        found.append((first, end - first, int.from_bytes(key, "little", signed=True),
                      words[starts[first] : ends[end + window - 2]]))
    return found


def _lengthened(rows: DataFrame, width: int, window: int, anchor: int) -> DataFrame:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (owner, first, key, doc, _digest(part), n, part)
                for owner, doc, words in zip(batch["digest"], batch["doc"], batch["words"])
                for first, n, key, part in lengthened(words, width, window, anchor)
            ]
            yield pd.DataFrame(rows, columns=_names(_PARTS))

    return rows.select("digest", "doc", "words").mapInPandas(cut, _PARTS)


def _common(first: bytes, last: bytes) -> int:
    """How many words two suffixes have in common; one of them may end."""
    left, right = first.split(b" "), last.split(b" ")
    low, high = 0, min(len(left), len(right))
    while low < high:
        middle = (low + high + 1) // 2
        if left[low:middle] == right[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def repeats(group: list[tuple[int, bytes, bytes]], window: int = WINDOW) -> list[tuple[bytes, int, int]]:
    """The repeats of one group that an earlier document holds: run, first word, length in words.

    A member is (doc, name, words), and members differ in their words. Their
    sorted suffixes are the leaves of a tree; leaves that share `window` words
    or more are below one deep inner node, whose depth is the length of a repeat.
    """
    if min(doc for doc, _, _ in group) == max(doc for doc, _, _ in group):
        return []
    leaves = []
    for number, (_, _, words) in enumerate(group):
        starts, ends = word_spans(words)
        deep = ends[window - 1 :].tolist()
        leaves += [(words[a:], b - a, number, k) for k, (a, b) in enumerate(zip(starts.tolist(), deep))]
    leaves.sort()
    taken: list[list[tuple[int, int]]] = [[] for _ in group]
    at = 0
    while at < len(leaves):
        node = leaves[at][0][: leaves[at][1]]
        end = at + 1
        while end < len(leaves) and leaves[end][0][: leaves[end][1]] == node:
            end += 1
        least = min(group[number][0] for _, _, number, _ in leaves[at:end])
        later = [(number, k) for _, _, number, k in leaves[at:end] if group[number][0] > least]
        if later:
            depth = _common(leaves[at][0], leaves[end - 1][0])
            for number, k in later:
                taken[number].append((k, depth))
        at = end
    found = []
    for (_, name, _), spans in zip(group, taken):
        reached = -1
        for k, depth in sorted(spans):
            if k + depth > reached:
                found.append((name, k, depth))
                reached = k + depth
    return found


def _trees(rows: DataFrame, window: int) -> DataFrame:
    """Repeats of every group of `rows`; a task holds one group at a time."""
    def grouped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        last, out = None, []
        for batch in batches:
            for key, *member in zip(*(batch[name].tolist() for name in ("key", "doc", "digest", "words"))):
                if key != last:
                    out += repeats(held, window) if held else []
                    last, held = key, []
                held.append(tuple(member))
            if out:
                yield pd.DataFrame(out, columns=_names(_FOUND))
                out = []
        out = repeats(held, window) if held else []
        if out:
            yield pd.DataFrame(out, columns=_names(_FOUND))

    dealt = rows.select("key", "doc", "digest", "words").repartition("key")
    return dealt.sortWithinPartitions("key").mapInPandas(grouped, _FOUND)


def _widths(window: int, anchor: int) -> list[int]:
    """How many places of the anchor share a prefix, step by step down to one."""
    found, width = [], window - anchor + 1
    while width > 1:
        width = -(-width // STEP)
        found.append(width)
    return found


def _repeated(
    members: DataFrame, firsts: DataFrame, rows: DataFrame, scratch: Scratch, window: int, anchor: int, group: int,
    widths: list[int],
) -> DataFrame:
    """Windows of the owners that an earlier document holds: `owner`, `at`, `n`.

    `members` are pieces of owners (owner, at, doc, digest, n), `firsts` has the
    least and the greatest doc of a digest, `rows` the words of digests by key.
    """
    whole = members.join(firsts.filter("least < most").select("digest", "least"), "digest").filter("doc > least")
    sizes = rows.groupBy("key").agg(F.sum("n").alias("windows"), F.min("doc").alias("least"), F.max("doc").alias("most"))
    sizes = scratch.save(sizes.filter("least < most").select("key", "windows"))
    large = sizes.filter(F.col("windows") > group) if widths else sizes.limit(0)
    small = sizes.filter(F.col("windows") <= group) if widths else sizes
    found = _trees(rows.join(small, "key"), window).select(
        "digest", "k", (F.col("length") - (window - 1)).alias("m")
    )
    if widths and not large.isEmpty():
        parts = scratch.save(_lengthened(rows.join(large, "key"), widths[0], window, anchor))
        merged = scratch.save(parts.groupBy("digest").agg(
            F.min("doc").alias("least"), F.max("doc").alias("most"), F.first("key").alias("key"),
            F.first("n").alias("n"), F.first("words").alias("words"),
        ))
        deeper = _repeated(
            parts.select("owner", "at", "doc", "digest", "n"), merged.select("digest", "least", "most"),
            merged.select("key", F.col("least").alias("doc"), "digest", "n", "words"),
            scratch, window, anchor, group, widths[1:],
        )
        found = found.union(deeper.select(F.col("owner").alias("digest"), F.col("at").alias("k"), F.col("n").alias("m")))
    found = scratch.save(found.join(firsts.select("digest", "least"), "digest"))
    inside = members.join(found, "digest").filter("doc = least").select("owner", (F.col("at") + F.col("k")).alias("at"), "m")
    return whole.select("owner", "at", "n").union(inside)


def copies(docs: DataFrame) -> DataFrame:
    """Documents whose whole text an earlier one has, as runs of all their windows."""
    rows = docs.filter("text IS NOT NULL").select("doc", "_hash", F.md5("text").alias("_digest"))
    first = rows.groupBy("_digest").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most")
    later = rows.join(first, "_digest").filter("doc > least")
    return later.select("doc", "_hash", F.lit(0).alias("start"), F.lit(ALL).alias("n")).distinct()


def repeated_windows(
    docs: DataFrame, scratch: Scratch, window: int = WINDOW, anchor: int = ANCHOR, group: int = GROUP
) -> DataFrame:
    """Runs of windows to take out: `doc`, `_hash`, `start`, `n`. `docs` is keyed."""
    twins = scratch.save(copies(docs))
    every = scratch.save(runs(docs, window, anchor).join(twins, ["doc", "_hash"], "left_anti"))
    ends = F.min("doc").alias("least"), F.max("doc").alias("most")
    # Saved, as below: a join of plain scans is one whose frequent keys Spark can split.
    shared = scratch.save(every.groupBy("anchor").agg(*ends).filter("least < most").select("anchor"))
    members = scratch.save(every.join(shared, "anchor").distinct())
    firsts = scratch.save(members.groupBy("digest").agg(
        F.min(F.struct("doc", "_hash", "start", "n", "anchor")).alias("first"), F.max("doc").alias("most")
    ).select("digest", "first.*", "most"))
    # An anchor whose runs all have the same words needs no tree.
    split = firsts.groupBy("anchor").agg(*ends).filter("least < most").select("anchor")
    rows = scratch.save(_with_words(docs, firsts.drop("most").join(split, "anchor"), window))
    found = _repeated(
        members.select(F.struct("doc", "_hash").alias("owner"), F.col("start").alias("at"), "doc", "digest", "n"),
        firsts.select("digest", F.col("doc").alias("least"), "most"), rows,
        scratch, window, anchor, group, _widths(window, anchor),
    )
    return twins.union(found.select("owner.doc", "owner._hash", F.col("at").alias("start"), "n"))


def deduplicated(
    docs: DataFrame, scratch: Scratch, window: int = WINDOW, anchor: int = ANCHOR, group: int = GROUP, text: str = "text"
) -> DataFrame:
    """The documents with `n_words`, `n_removed` and `kept`, the words that stay joined by one space.

    Other columns stay; those of the input with these three names are replaced.
    A null text has a null `kept`.
    """
    @F.pandas_udf(StructType([
        StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())
    ]))
    def rest(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for value, gone in zip(texts, found):
            words = as_bytes(value).split()
            mask = np.ones(len(words), bool)
            for run in gone if gone is not None and len(words) >= window else ():
                end = len(words) if run["n"] == ALL else run["start"] + run["n"] + window - 1
                mask[run["start"] : end] = False
            kept = words if mask.all() else [words[n] for n in np.flatnonzero(mask)]
            left = b" ".join(kept).decode("utf-8", "surrogatepass") if isinstance(value, str) else None
            rows.append((len(words), len(words) - len(kept), left))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    found = repeated_windows(_keyed(docs, text), scratch, window, anchor, group)
    per_doc = found.groupBy(F.col("doc").alias("_doc"), F.col("_hash").alias("_mark")).agg(
        F.collect_set(F.struct("start", "n")).alias("found")
    )
    own = [name for name in docs.columns if name not in ("n_words", "n_removed", "kept")]
    # The text goes through the join once: inside the row, if it is one of the columns that stay.
    inside = F.col(f"row.{text}") if text in own else F.col("_text")
    rows = docs.select(F.struct(*own).alias("row"), _rank(F.col("doc_id")).alias("_rank"),
                       F.xxhash64(text).alias("_text_hash"), *([] if text in own else [F.col(text).alias("_text")]))
    joined = rows.join(per_doc, (F.col("_rank") == F.col("_doc")) & (F.col("_text_hash") == F.col("_mark")), "left")
    return joined.select("row", rest(inside, "found").alias("rest")).select("row.*", "rest.*")
