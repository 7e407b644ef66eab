"""A keyed table in hash buckets, kept up by an `update`-mode stream.

    changes/batch_id=<n>/_bucket=<b>    rows that batch n has changed
    base/batch_id=<n>/_bucket=<b>       all rows of bucket b as of batch n
    state/<n>                           after batch n: the batch of every bucket's base,
                                        and what the caller wants to commit with it

A batch writes its changed rows by bucket. Only a bucket whose changes have grown
to a share of its base is written anew, so that the bytes written stay in
proportion to the bytes changed. The file in `state` is written last and appears
by a rename: rows, bases and notes of a batch (such as offsets) become visible
together. A batch that is repeated starts from the state before it, and files
that its first run has left are overwritten.

A key is in one bucket for ever: `buckets` cannot be changed later.
"""

from __future__ import annotations

import json
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.operators.upsert import latest_per_key
from tallywork.streaming.runner import BatchAction, BatchFunction, files_below, read_text, remove, write_text

BUCKET, BATCH = "_bucket", "batch_id"


class BucketTable:
    """The table below `path`; its rows have the schema of the stream."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64, share: float = 0.5) -> None:
        self.spark, self.path, self.keys = spark, path, keys
        self.buckets, self.share = buckets, share

    # --- reading

    def last(self, before: int | None = None) -> dict | None:
        """The newest state, or the newest that is older than a batch."""
        numbers = [int(name) for name in files_below(self.spark, f"{self.path}/state") if name.isdigit()]
        numbers = [number for number in numbers if before is None or number < before]
        return json.loads(read_text(self.spark, f"{self.path}/state/{max(numbers)}")) if numbers else None

    def rows(self) -> DataFrame:
        """The table as of its newest state: per key the newest row."""
        state = self.last()
        if state is None:
            raise ValueError(f"no batch has been committed below {self.path}")
        schema = T.StructType.fromJson(state["schema"])
        return self._rows(state, schema, None, None)

    def rows_before(self, batch_id: int, like: DataFrame) -> DataFrame:
        """The rows, as they were before a batch, that have the keys of `like`; only buckets of those keys are read."""
        state = self.last(batch_id)
        buckets = {row[0] for row in like.select(self._bucket()).distinct().collect()}
        if state is None or not buckets:
            return self.spark.createDataFrame([], like.schema)
        rows = self._rows(state, T.StructType.fromJson(state["schema"]), buckets, None)
        keys = like.select(*[F.col(key).alias(f"_like_{key}") for key in self.keys]).distinct()
        same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_like_{key}")) for key in self.keys])
        return rows.join(keys, same, "left_semi")

    def note(self) -> object:
        """What the newest batch has committed beside its rows."""
        state = self.last()
        return state and state["note"]

    def _rows(self, state: dict, schema: T.StructType, chosen: set[int] | None, extra: int | None) -> DataFrame:
        """Newest rows of some or all buckets, by the bases of a state and the changes up to it and of batch `extra`."""
        bases = {int(bucket): batch for bucket, batch in state["bases"].items()}
        changes = [*state["changes"], *([] if extra is None else [extra])]
        paths, since = [], []
        for bucket in range(self.buckets):
            if chosen is not None and bucket not in chosen:
                continue
            if bucket in bases:
                paths.append(f"{self.path}/base/{BATCH}={bases[bucket]}/{BUCKET}={bucket}")
            since += [f"{self.path}/changes/{BATCH}={batch}/{BUCKET}={bucket}" for batch in changes if batch > bases.get(bucket, -1)]
        there = self._there(changes)
        parts = [self._read(paths, "base", schema), self._read([path for path in since if path in there], "changes", schema)]
        found = reduce(DataFrame.unionByName, [part for part in parts if part is not None] or [self._none(schema)])
        return latest_per_key(found, self.keys, BATCH).drop(BATCH)

    def _there(self, batches: list[int]) -> set[str]:
        """The bucket folders that these batches have written."""
        folders = [f"{self.path}/changes/{BATCH}={batch}" for batch in batches]
        return {f"{folder}/{name}" for folder in folders for name in files_below(self.spark, folder)}

    def _none(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())]))

    def _read(self, paths: list[str], kind: str, schema: T.StructType) -> DataFrame | None:
        if not paths:
            return None
        stored = T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/{kind}").parquet(*paths).drop(BUCKET)

    # --- writing

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str, batch_id: int, dealt: bool) -> dict[int, int]:
        """Store rows by bucket; bytes per bucket. `dealt`: a bucket's rows go to one file."""
        path = f"{self.path}/{kind}/{BATCH}={batch_id}"
        rows = rows.withColumn(BUCKET, self._bucket())
        if dealt:
            rows = rows.repartition(BUCKET)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        return self._sizes(path)

    def _sizes(self, path: str) -> dict[int, int]:
        names = files_below(self.spark, path)
        folders = {name: int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET}=")}
        return {number: sum(files_below(self.spark, f"{path}/{name}").values()) for name, number in folders.items()}

    def commit(self, batch: DataFrame, batch_id: int, note: object = None) -> None:
        """Upsert one batch, which has one row per key, and commit it with a note."""
        before = self.last(batch_id)
        state = before or {"batch": -1, "bases": {}, "base_bytes": {}, "changes": [], "change_bytes": {}}
        changed = defaultdict(int, {int(bucket): size for bucket, size in state["change_bytes"].items()})
        for bucket, size in self._write(batch, "changes", batch_id, dealt=True).items():
            changed[bucket] += size
        base_bytes = {int(bucket): size for bucket, size in state["base_bytes"].items()}
        full = {bucket for bucket, size in changed.items() if size > self.share * base_bytes.get(bucket, 0)}
        bases = {int(bucket): number for bucket, number in state["bases"].items()}
        if full:
            rows = self._rows(state, batch.schema, full, batch_id)
            base_bytes |= self._write(rows, "base", batch_id, dealt=True)
            for bucket in full:
                bases[bucket] = batch_id
                changed.pop(bucket)
        oldest = min((bases.get(bucket, -1) for bucket in changed), default=batch_id)
        kept = [number for number in [*state["changes"], batch_id] if number > oldest]
        after = {
            "batch": batch_id, "schema": batch.schema.jsonValue(), "bases": bases, "base_bytes": base_bytes,
            "changes": kept, "change_bytes": changed, "note": note,
        }
        write_text(self.spark, f"{self.path}/state/{batch_id}", json.dumps(after))
        self._clean(batch_id, before, after)

    def _clean(self, batch_id: int, before: dict | None, after: dict) -> None:
        """Remove what neither this state nor the one before it needs: a repeated batch reads the latter."""
        if before is None:
            return
        changes = {*before["changes"], *after["changes"], batch_id}
        bases = {(number, int(bucket)) for state in (before, after) for bucket, number in state["bases"].items()}
        for name in files_below(self.spark, f"{self.path}/changes"):
            if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) not in changes:
                remove(self.spark, f"{self.path}/changes/{name}")
        for name in files_below(self.spark, f"{self.path}/base"):
            number = int(name.split("=")[1]) if name.startswith(f"{BATCH}=") else -1
            mine = {bucket for batch, bucket in bases if batch == number}
            if not mine:
                remove(self.spark, f"{self.path}/base/{name}")
                continue
            for part in files_below(self.spark, f"{self.path}/base/{name}"):
                if part.startswith(f"{BUCKET}=") and int(part.split("=")[1]) not in mine:
                    remove(self.spark, f"{self.path}/base/{name}/{part}")
        for name in files_below(self.spark, f"{self.path}/state"):
            if name.isdigit() and int(name) < before["batch"]:
                remove(self.spark, f"{self.path}/state/{name}")


def bucket_table_action(table: BucketTable, function: BatchFunction | None = None, note: BatchFunction | None = None) -> BatchAction:
    """Action that upserts each batch, or a function of it, into the table.

    `note` is a small aggregate of the batch, such as its offset ranges: its
    rows are committed together with the batch's.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        told = None if note is None else [row.asDict(recursive=True) for row in note(batch).collect()]
        table.commit(batch if function is None else function(batch), batch_id, told)

    return action
