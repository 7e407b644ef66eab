"""Token-ID output: shards of separately compressed documents under one shared dictionary.

A shard is one row of a Parquet table, so that Spark's writer commits it and any
store can hold it. Its layout, all integers little-endian:

  index  magic `TKID`, version u16, bytes per id u16, SHA-256 of the dictionary
         (32 bytes), number of documents n u32, then n+1 offsets u64 into `data`
  data   n zstandard frames, each the ids of one document

`first_id`, `last_id` and `doc_ids` find a document's shard and place; its
frame alone is decompressed then. The dictionary is trained on the serialized
ids of at most `SAMPLE` documents, the least by a hash of their doc_id, and of
each at most `PIECES` pieces of `PIECE` bytes. It is stored beside the shards,
and readers refuse another one.

Shards follow the order of doc_id, nulls first; equal ids are ordered by text.
Null and empty texts hold the end id alone. An empty table gives no shards.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.llm.wording import as_bytes

MAGIC, VERSION, END = b"TKID", 1, 1
SAMPLE, PIECES, PIECE, DICTIONARY = 1000, 4, 8192, 1 << 16
SHARD_BYTES, SHARD_DOCS, LEVEL = 4 << 20, 4096, 3
KEPT_WORDS, KEPT_PIECES, TOGETHER = 100_000, 500_000, 64
_HEAD = "<4sHH32sI"
_SHARD = (
    "part int, shard int, first_id long, last_id long, doc_ids array<long>, n_tokens array<int>, "
    "index binary, data binary"
)


# The rules by which `Encoder` may cut texts into words, as a tokenizer file states them.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}

# Plain texts hold characters up to U+017F, all of them composed: no apostrophe, which may cut elsewhere, no control
# characters, and no letter that is two in lower case. In UTF-8 that is these bytes without these characters.
_PLAIN = bytes([*range(9, 14), *range(32, 39), *range(40, 127), 0xC3, 0xC4, 0xC5, *range(0x80, 0xC0)])
_NOT_PLAIN = ("×", "÷", "İ")
#: Pieces of a plain text in lower case.
_PIECES = re.compile(r"[a-zß-öø-įı-ſ]+|[0-9]|[!-/:-@\[-`{-~]+")


def cut_by_words(path: str) -> bool:
    """Whether a tokenizer file states the rules above and nothing that reaches across white space."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, added = spec["model"], spec["added_tokens"]
    return (
        spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == PRE_TOKENIZER
        and not spec["post_processor"] and not spec["truncation"] and not spec["padding"]
        and model["type"] == "BPE" and not model["dropout"] and not model["ignore_merges"]
        and not any(one["lstrip"] or one["rstrip"] or one["single_word"] or one["normalized"]
                    or re.search(r"\s", one["content"]) for one in added)
    )


class Kept(dict):
    """What `learn` gave for the keys met last: between `limit` and twice as many entries."""

    def __init__(self, limit: int, learn: Callable):
        super().__init__()
        self.limit, self.learn, self.older = limit, learn, {}

    def __missing__(self, key):
        value = self[key] = self.older.get(key) or self.learn(key)
        return value

    def turn(self) -> None:
        """Make room: entries that are not met before the next turn go."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, with the ids of seen words kept.

    A tokenizer with the rules above drops white space and never looks across
    it. The ids of a plain text are those of its pieces, which go straight to
    the tokenizer's merges; a text with other characters is cut into words, and
    those that hold them go whole through the tokenizer. Texts go whole through
    any tokenizer with other rules.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = cut_by_words(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.not_plain = (*_NOT_PLAIN, *(one.content for one in self.tokenizer.get_added_tokens_decoder().values()))
        self.merges = self.tokenizer.model.tokenize
        # Fixed value: the characters that stand for bytes in this kind of vocabulary.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [byte for byte in range(256) if byte not in plain]
        self.letters = {byte: 256 + n for n, byte in enumerate(others)}
        self.words, self.pieces = Kept(KEPT_WORDS, self._word), Kept(KEPT_PIECES, self._piece)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.merges(shown)]).tobytes()

    def _is_plain(self, data: bytes, text: str) -> bool:
        return not data.translate(None, _PLAIN) and not any(one in text for one in self.not_plain)

    def _by_pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        return self._by_pieces(text) if self._is_plain(word, text) else self._whole(text)

    def _text(self, text: str | None) -> bytes:
        data = as_bytes(text)
        if not data or not self.by_words:
            return self._whole(text) if data else b""
        if self._is_plain(data, text):
            return self._by_pieces(text)
        return b"".join(map(self.words.__getitem__, data.split()))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        self.words.turn()
        self.pieces.turn()
        return [self._text(text) for text in texts]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process. A worker runs many tasks, and words met in one are known in the next."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


_END_BYTES = struct.pack("<I", END)


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A zstandard dictionary for these documents' ids; empty if they are too few to train one."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = encoder(tokenizer)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                data = _narrow(worker.encode(text) + _END_BYTES, worker.width)
                count = min(PIECES, -(-len(data) // PIECE))
                starts = np.linspace(0, max(0, len(data) - PIECE), count).astype(int) // worker.width * worker.width
                rows += [data[at : at + PIECE] for at in starts]
            yield pd.DataFrame({"piece": rows})

    sample = docs.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi").select("text").limit(SAMPLE)
    samples = [bytes(row[0]) for row in sample.mapInPandas(cut, "piece binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY, sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _encoded(worker: Encoder, texts: pd.Series) -> Iterator[bytes]:
    gc.disable()  # the kept pieces are many objects to search, and none of them can be in a cycle
    try:
        for at in range(0, len(texts), TOGETHER):
            yield from worker.encode_all(texts.iloc[at : at + TOGETHER].tolist())
    finally:
        gc.enable()


def _codec(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode `doc_id` and `text` to token files below `path`."""
    dictionary = train_dictionary(docs, tokenizer)
    mark = hashlib.sha256(dictionary).digest()
    spark = docs.sparkSession
    held = F.unhex(F.lit(dictionary.hex()))
    spark.range(1, numPartitions=1).select(F.lit(mark.hex()).alias("sha256"), held.alias("dictionary")).write.parquet(
        f"{path}/dictionary"
    )

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        codec = _codec(dictionary)
        if codec:
            codec["dict_data"].precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(level=LEVEL, **codec)
        ids: list = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = 0

        def row() -> pd.DataFrame:
            offsets = np.concatenate(([0], np.cumsum([len(frame) for frame in frames]))).astype("<u8")
            head = struct.pack(_HEAD, MAGIC, VERSION, worker.width, mark, len(frames))
            known = [one for one in ids if one is not None]
            return pd.DataFrame({
                "part": [part], "shard": [number],
                "first_id": pd.array([known[0] if known else None], "Int64"),
                "last_id": pd.array([known[-1] if known else None], "Int64"),
                "doc_ids": [ids], "n_tokens": [counts], "index": [head + offsets.tobytes()], "data": [b"".join(frames)],
            })

        for batch in batches:
            for doc_id, ids_of_text in zip(batch["doc_id"], _encoded(worker, batch["text"])):
                data = ids_of_text + _END_BYTES
                frame = packer.compress(_narrow(data, worker.width))
                if frames and (size + len(frame) > SHARD_BYTES or len(frames) >= SHARD_DOCS):
                    yield row()
                    ids, counts, frames, size, number = [], [], [], 0, number + 1
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                counts.append(len(data) // 4)
                frames.append(frame)
                size += len(frame)
        if frames:
            yield row()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # As text, since pandas would turn long numbers beside a null into floating-point numbers.
    plain = ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    plain.mapInPandas(shards, _SHARD).write.parquet(f"{path}/shards")


def _dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return dictionary


class Shard:
    """Access to the documents of one shard; only what is asked for is decompressed."""

    def __init__(self, index: bytes, data: bytes, mark: bytes, unpacker: zstandard.ZstdDecompressor):
        """`mark` is the SHA-256 of the dictionary at hand."""
        magic, version, width, written, self.count = struct.unpack_from(_HEAD, index)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard of this version")
        if written != mark:
            raise ValueError("the shard was written with another dictionary")
        self.kind, self.data, self.unpacker = "<u2" if width == 2 else "<u4", data, unpacker
        self.offsets = np.frombuffer(index, "<u8", self.count + 1, struct.calcsize(_HEAD))

    def ids(self, place: int) -> np.ndarray:
        start, end = self.offsets[place : place + 2].tolist()
        return np.frombuffer(self.unpacker.decompress(self.data[start:end]), self.kind).astype("<u4")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: its place (`part`, `shard`, `place`), doc_id, and `ids` as unsigned 32-bit bytes."""
    dictionary = _dictionary(spark, path)

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpacker, mark = zstandard.ZstdDecompressor(**_codec(dictionary)), hashlib.sha256(dictionary).digest()
        for batch in batches:
            for shard in batch.itertuples(name=None, index=False):
                part, number, doc_ids, index, data = shard
                opened, count = Shard(index, data, mark, unpacker), len(doc_ids)
                for start in range(0, count, 256):
                    places = range(start, min(start + 256, count))
                    yield pd.DataFrame({
                        "part": part, "shard": number, "place": list(places),
                        "doc_id": pd.array([None if pd.isna(doc_ids[n]) else int(doc_ids[n]) for n in places], "Int64"),
                        "ids": [opened.ids(n).tobytes() for n in places],
                    })

    stored = spark.read.schema(_SHARD).parquet(f"{path}/shards").select(
        "part", "shard", F.col("doc_ids").cast("array<string>").alias("doc_ids"), "index", "data"
    )
    return stored.mapInPandas(documents, "part int, shard int, place int, doc_id long, ids binary")


def document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this doc_id: the statistics of `first_id` and `last_id` choose the shards."""
    dictionary = _dictionary(spark, path)
    shards = spark.read.schema(_SHARD).parquet(f"{path}/shards")
    shards = shards.filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    unpacker, mark = zstandard.ZstdDecompressor(**_codec(dictionary)), hashlib.sha256(dictionary).digest()
    found = []
    for row in shards.orderBy("part", "shard").toLocalIterator():
        shard = Shard(bytes(row["index"]), bytes(row["data"]), mark, unpacker)
        found += [shard.ids(place).tolist() for place, one in enumerate(row["doc_ids"]) if one == doc_id]
    return found


def starts(rows: DataFrame) -> DataFrame:
    """Add `start`, the number of ids of all documents before; `rows` has part, shard, place and n_tokens."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    # One row per partition of the writer meets in this window.
    before = F.sum("_total").over(Window.orderBy("part")) - F.col("_total")
    totals = totals.select("part", before.alias("_before"))
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard", "place")) - F.col("n_tokens")
    return rows.withColumn("_own", own).join(totals, "part").withColumn("start", F.col("_before") + F.col("_own"))
