"""Bigram language model, interpolated modified Kneser-Ney, counted in Spark and read from mapped arrays.

Words are 64-bit hashes; in pairs and contexts each is the upper half of its
hash, a 32-bit id. Whether a word is known is decided by its full hash; two known
words share an id with probability V / 2^32. Three kinds of counts exist, each as
arrays sorted by key:

  word   hash of a token: how often it occurs
  pair   mixed (id, id of the next token): how often it occurs
  id     as a context: occurrences, pairs seen once, twice, more often; and the
         number of different tokens before it

Each kind is cut into buckets by the upper bits of its keys, which are evenly
spread however frequent a word is; the number of buckets follows the size of the
corpus. Tasks send sorted, compressed arrays per bucket, and one task adds up a
bucket and stores it as two `.npy` files. Workers map those files, sort a batch
of tokens and look each different one up once.

The folder has to be mounted on every machine, as mapped files must. Files are
written under another name and then renamed, so that a repeated task is harmless.

Null and empty texts consist of the end token. Without any training text every
probability is 1 / (V + 1) with V = 0.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tallywork.llm.scratch import Scratch
from tallywork.llm.wording import LOWER_BYTES, as_bytes, mixed, span_hashes, word_spans

WORD, PAIR, ID = 0, 1, 2
END, START = np.uint64(0x9AE16A3B2F90404F), np.uint64(0x165667B1)  # the end token's hash, the start's id
BUCKET_BYTES, CHUNK_BYTES, CHUNK_TOKENS = 8 << 20, 2 << 20, 2_000_000
_HALF = np.uint64(32)
_ROWS = "kind int, bucket int, data binary, facts array<long>"
_UNMIX = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


def unmixed(values: np.ndarray) -> np.ndarray:
    """The inverse of `mixed`; a shift by half the width undoes itself."""
    values = (values ^ (values >> _HALF)) * _UNMIX
    values = (values ^ (values >> _HALF)) * _UNMIX
    return values ^ (values >> _HALF)


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, and how many each text has."""
    parts = [as_bytes(text).translate(LOWER_BYTES) for text in texts]
    data = b" ".join(parts)
    starts, ends = word_spans(data)
    begins = np.concatenate(([0], np.cumsum([len(part) + 1 for part in parts])))[:-1]
    owner = np.searchsorted(begins, starts, "right") - 1
    counts = np.bincount(owner, minlength=len(parts)) + 1
    found = np.full(len(starts) + len(parts), END, np.uint64)
    found[np.arange(len(starts)) + owner] = span_hashes(data, starts, ends)
    return found, counts


def contexts(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The id before each token; the start's for the first of a text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(counts) - counts] = START
    return before


def pair_keys(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mixed((before << _HALF) | ids)


def _chunks(texts: pd.Series) -> Iterator[list[str | None]]:
    """Parts of a batch with about `CHUNK_BYTES` of text, one row at least."""
    sizes = np.array([len(text) if isinstance(text, str) else 0 for text in texts], np.int64)
    part = np.cumsum(sizes) // CHUNK_BYTES
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    for at, end in zip(edges, np.append(edges[1:], len(texts))):
        yield texts.iloc[at:end].tolist()


def added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their values (one row of values per key)."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(values, first, axis=0) if len(keys) else values


def _packed(keys: np.ndarray, values: np.ndarray) -> bytes:
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    columns = np.ascontiguousarray(values.astype("<i8").T)
    # Bytes of equal weight stand together: most are zero.
    raw = [steps.view(np.uint8).reshape(-1, 8).T.tobytes(), columns.view(np.uint8).reshape(-1, 8).T.tobytes()]
    return zstandard.compress(np.array([len(keys), columns.shape[0]], "<i8").tobytes() + b"".join(raw), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    count, width = np.frombuffer(raw, "<i8", 2).tolist()
    octets = np.frombuffer(raw, np.uint8, offset=16)
    steps = np.ascontiguousarray(octets[: 8 * count].reshape(8, -1).T).view("<u8").reshape(-1)
    values = np.ascontiguousarray(octets[8 * count :].reshape(8, -1).T).view("<i8").reshape(width, -1)
    return np.cumsum(steps, dtype=np.uint64), values.T


def _by_bucket(kind: int, keys: np.ndarray, values: np.ndarray, bits: int) -> Iterator[tuple]:
    """Rows of packed arrays; keys are in order."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
    edges = [0, *map(int, cuts), len(keys)]
    for bucket, (at, end) in enumerate(zip(edges, edges[1:])):
        if end > at:
            yield kind, bucket, _packed(keys[at:end], values[at:end]), None


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "bucket", "data", "facts"])


def _count_rows(docs: DataFrame, bits: int) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pd.DataFrame:
            rows = []
            for kind, place in ((WORD, 0), (PAIR, 1)):
                keys, counts = np.unique(np.concatenate([one[place] for one in held]), return_counts=True)
                rows += _by_bucket(kind, keys, counts[:, None], bits)
            return _frame(rows)

        for chunk in (part for batch in batches for part in _chunks(batch["text"])):
            found, counts = tokens(chunk)
            ids = found >> _HALF
            held.append((found, pair_keys(contexts(ids, counts), ids)))
            if sum(len(one[0]) for one in held) >= CHUNK_TOKENS:
                yield out()
                held = []
        if held:
            yield out()

    return docs.select("text").mapInPandas(count, _ROWS)


def _store(folder: str, kind: int, bucket: int, keys: np.ndarray, values: np.ndarray) -> None:
    for name, array in (("keys", keys), ("values", values)):
        path = f"{folder}/{kind}-{bucket}.{name}.npy"
        draft = f"{path}.{uuid.uuid4().hex}"
        with open(draft, "wb") as file:
            np.save(file, array)
        os.replace(draft, path)


def _times(values: np.ndarray) -> list[int]:
    """How many values are 1, 2, 3, 4, over 2."""
    return [int((values == n).sum()) for n in (1, 2, 3, 4)] + [int((values > 2).sum())]


def _id_rows(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What pairs say about their two ids."""
    pairs = unmixed(keys)
    values = np.zeros((2 * len(keys), 5), np.int64)
    first = values[: len(keys)]
    first[:, 0], first[:, 1], first[:, 2], first[:, 3] = counts, counts == 1, counts == 2, counts > 2
    values[len(keys) :, 4] = 1
    return added(np.concatenate((pairs & ~np.uint64(0xFFFFFFFF), pairs << _HALF)), values)


def _added_up(rows: DataFrame, folder: str, bits: int) -> DataFrame:
    """Store each bucket; rows of facts per bucket, and what pairs say about ids."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        key, held = None, []

        def out() -> pd.DataFrame:
            keys, values = added(*(np.concatenate(each) for each in zip(*map(_unpacked, held))))
            kind, bucket = key
            _store(folder, kind, bucket, keys, values.astype(np.uint32 if values.max() < 1 << 32 else np.int64))
            found = []
            if kind == PAIR:
                found += _by_bucket(ID, *_id_rows(keys, values[:, 0]), bits)
            column = values[:, -1]
            found.append((kind, bucket, None, [len(keys), int(column.sum()), *_times(column)]))
            return _frame(found)

        for batch in batches:
            for kind, bucket, data in zip(batch["kind"], batch["bucket"], batch["data"]):
                if held and key != (kind, bucket):
                    yield out()
                    held = []
                key = (kind, bucket)
                held.append(data)
        if held:
            yield out()

    dealt = rows.select("kind", "bucket", "data").repartition("kind", "bucket")
    return dealt.sortWithinPartitions("kind", "bucket").mapInPandas(add, _ROWS)


class Discounts(NamedTuple):
    one: float
    two: float
    more: float

    def of(self, counts: np.ndarray) -> np.ndarray:
        return np.select([counts <= 0, counts == 1, counts == 2], [0.0, self.one, self.two], self.more)


def discounts(n1: int, n2: int, n3: int, n4: int) -> Discounts:
    """Modified Kneser-Ney discounts; half a count less per step where the numbers give none."""
    base = n1 / (n1 + 2 * n2) if n1 else 0.0
    pairs = ((1, n1, n2), (2, n2, n3), (3, n3, n4))
    found = [k - (k + 1) * base * after / before if before and base else k / 2 for k, before, after in pairs]
    return Discounts(*(min(max(value, 0.0), float(k)) for k, value in enumerate(found, 1)))


class Model(NamedTuple):
    """What the arrays in `folder` need besides them. `tokens`, `words`: N and V of the training text."""

    folder: str
    bits: int
    tokens: int
    words: int
    pairs: int
    pair_cuts: Discounts
    next_cuts: Discounts
    next_rest: float  # the share of the lower order that goes to all words alike


def local_path(folder: str) -> str:
    """The mounted folder of a `file:` address or plain path."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    if "://" in folder:
        raise ValueError(f"{folder}: arrays are mapped, so the shared folder must be mounted (file:)")
    return folder


def train(docs: DataFrame, scratch: Scratch) -> Model:
    """Count `text` and store the arrays in a folder beside the scratch tables."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(0, int(size // BUCKET_BYTES).bit_length()))
    folder = local_path(scratch.folder) + "/arrays"
    first = scratch.save(_added_up(_count_rows(docs, bits), folder, bits))
    second = scratch.save(_added_up(first.filter("data IS NOT NULL"), folder, bits))
    facts = first.union(second).filter("facts IS NOT NULL")
    rows = facts.groupBy("kind").agg(*[F.sum(F.get("facts", F.lit(n))).alias(f"f{n}") for n in range(7)]).collect()
    sums = {row["kind"]: [row[f"f{n}"] for n in range(7)] for row in rows}
    empty = [0] * 7
    word, pair, after = (sums.get(kind, empty) for kind in (WORD, PAIR, ID))
    cuts = discounts(*after[2:6])
    rest = (cuts.one * after[2] + cuts.two * after[3] + cuts.more * after[6]) / pair[0] if pair[0] else 1.0
    return Model(folder, bits, word[1], word[0], pair[0], discounts(*pair[2:6]), cuts, rest)


def _mapped(folder: str, kind: int, bucket: int, maps: dict):
    """The arrays of a bucket, or None; `maps` keeps what a task has opened."""
    if (kind, bucket) not in maps:
        path = f"{folder}/{kind}-{bucket}"
        maps[kind, bucket] = os.path.exists(f"{path}.keys.npy") and tuple(
            np.load(f"{path}.{name}.npy", mmap_mode="r") for name in ("keys", "values")
        )
    return maps[kind, bucket] or None


def _looked_up(model: Model, maps: dict, kind: int, keys: np.ndarray, width: int = 1) -> np.ndarray:
    """The values of different keys in order; zero where there are none."""
    found = np.zeros((len(keys), width), np.int64)
    buckets = (keys >> np.uint64(64 - model.bits)).astype(np.int64) if model.bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.diff(buckets, prepend=-1))
    for at, end in zip(edges, np.append(edges[1:], len(keys))):
        arrays = _mapped(model.folder, kind, int(buckets[at]), maps)
        if arrays is None:
            continue
        stored, values = arrays
        places = np.minimum(np.searchsorted(stored, keys[at:end]), len(stored) - 1)
        same = stored[places] == keys[at:end]
        found[at:end][same] = values[places[same]]
    return found


def score_texts(model: Model, texts: list[str | None], maps: dict) -> pd.DataFrame:
    """Tokens, known tokens, base score and score (log10) of each text."""
    found, counts = tokens(texts)
    words, place = np.unique(found, return_inverse=True)
    times = _looked_up(model, maps, WORD, words)[:, 0]
    base = np.log10((times + 0.5) / (model.tokens + 0.5 * (model.words + 1)))[place]
    known = (times > 0)[place]
    ids = found >> _HALF
    before = contexts(ids, counts)
    kept, where = np.unique(np.concatenate((ids, before)) << _HALF, return_inverse=True)
    facts = _looked_up(model, maps, ID, kept, 5)
    preceded, total, cuts = facts[:, 4], facts[:, 0], model.pair_cuts
    share = np.maximum(preceded - model.next_cuts.of(preceded), 0) / max(model.pairs, 1)
    # Of words that are not known by their full hash, an id says nothing.
    lower = np.where(known, share[where[: len(ids)]], 0.0) + model.next_rest / (model.words + 1)
    spare = (cuts.one * facts[:, 1] + cuts.two * facts[:, 2] + cuts.more * facts[:, 3]) / np.maximum(total, 1)
    first = np.cumsum(counts) - counts
    told = np.concatenate(([True], known[:-1]))
    told[first] = True
    told &= (total > 0)[where[len(ids) :]]
    spare, total = np.where(told, spare[where[len(ids) :]], 1.0), np.maximum(total, 1)[where[len(ids) :]]
    pairs, at = np.unique(pair_keys(before, ids), return_inverse=True)
    seen = _looked_up(model, maps, PAIR, pairs)[:, 0]
    direct = np.where(known & told, np.maximum(seen - cuts.of(seen), 0)[at] / total, 0.0)
    return pd.DataFrame({
        "n_tokens": counts, "n_known": np.add.reduceat(known.astype(np.int64), first),
        "base_score": np.add.reduceat(base, first),
        "score": np.add.reduceat(np.log10(direct + spare * lower), first),
    })


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score, score and perplexity; columns with these names are replaced."""
    names = ["n_tokens", "n_known", "base_score", "score"]

    @F.pandas_udf(StructType([
        StructField(name, DoubleType() if name.endswith("score") else LongType()) for name in names
    ]))
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        maps: dict = {}
        for batch in batches:
            parts = [score_texts(model, texts, maps) for texts in _chunks(batch)]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=names)

    own = [name for name in docs.columns if name not in (*names, "train_tokens", "perplexity")]
    rows = docs.select(F.struct(*own).alias("row"), scored(F.col(text)).alias("scored"))
    perplexity = F.pow(F.lit(10.0), -F.col("scored.score") / F.col("scored.n_tokens"))
    return rows.select(
        "row.*", "scored.*", F.lit(model.tokens).cast("long").alias("train_tokens"), perplexity.alias("perplexity")
    )
