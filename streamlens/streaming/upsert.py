"""Keyed upsert of streaming results (S7): a table with one row per key.

Rows lie in ``buckets`` hash buckets.  A micro-batch rewrites only the buckets
that its keys fall in, below a folder of its own, and then publishes a manifest
(bucket -> the batch that last wrote it) by one rename.  Reading takes the
newest manifest's folders as they are: one row per key, no reduction.

A batch that is delivered again starts from the manifest before it and replaces
its own folder, so it changes nothing.  After publishing, folders that neither
this manifest nor the one before names are removed: readers of the last state
and a replay of the last batch still find theirs.

``buckets`` (16 by default) is fixed by the first batch.  Choose it so that a bucket's rows fit
a task: a batch's work is the buckets it touches, not the table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.sources.files import filesystem

_BUCKET = "upsert_bucket"


class Table:
    """An upsert table below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 16):
        if _BUCKET in (c.lower() for c in schema.fieldNames()):
            raise ValueError(f"a column must not be named {_BUCKET}")
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets
        self.fs, self.base = filesystem(self.path)

    def _manifests(self) -> dict[int, str]:
        from pyarrow import fs
        found = self.fs.get_file_info(fs.FileSelector(f"{self.base}/manifests", allow_not_found=True))
        return {int(f.base_name.split(".")[0]): f.path for f in found if f.base_name.endswith(".json")
                and not f.base_name.startswith(".")}

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """bucket -> batch of the newest manifest (older than batch ``before``)."""
        found = self._manifests()
        ids = [i for i in found if before is None or i < before]
        if not ids:
            return {}
        with self.fs.open_input_stream(found[max(ids)]) as f:
            state = json.loads(f.read())
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {state['buckets']} buckets, not {self.buckets}")
        return {int(b): n for b, n in state["batches"].items()}

    def _folders(self, manifest: dict[int, int]) -> list[str]:
        return [f"{self.path}/batch={n}/{_BUCKET}={b}" for b, n in manifest.items()]

    def _read(self, manifest: dict[int, int]) -> DataFrame:
        if not manifest:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*self._folders(manifest))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        """All rows, one per key."""
        return self._read(self.manifest())

    def read_touched(self, touched: list[int], before: int) -> DataFrame:
        """The rows of some buckets as of the start of a batch."""
        state = self.manifest(before)
        return self._read({b: state[b] for b in touched if b in state})

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows' keys (at most ``buckets`` numbers)."""
        return [r[0] for r in rows.select(self.bucket()).distinct().collect()]

    def upsert(self, changes: DataFrame, batch_id: int, keep: Column | None = None) -> None:
        """Replace the rows of the changes' keys (one change per key at most);
        ``changes`` is read three times, so pass a written frame.  Old rows of
        the touched buckets that ``keep`` does not hold for are dropped."""
        state = self.manifest(batch_id)
        touched = self.touched(changes)
        old = self._read({b: state[b] for b in touched if b in state})
        same = None
        for k in self.keys:
            c = F.col(f"old.`{k}`").eqNullSafe(F.col(f"new.`{k}`"))
            same = c if same is None else same & c
        old = old if keep is None else old.where(keep)
        kept = old.alias("old").join(changes.select(*self.keys).alias("new"), same, "left_anti")
        if touched:
            (kept.unionByName(changes.select(*self.schema.fieldNames())).withColumn(_BUCKET, self.bucket())
             .repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/batch={batch_id}"))
        self._publish({**state, **dict.fromkeys(touched, batch_id)}, batch_id)
        self._clean(state, batch_id)

    def _publish(self, manifest: dict[int, int], batch_id: int) -> None:
        self.fs.create_dir(f"{self.base}/manifests", recursive=True)
        tmp = f"{self.base}/manifests/.{batch_id}.json"
        with self.fs.open_output_stream(tmp) as f:
            f.write(json.dumps({"buckets": self.buckets, "batches": manifest}).encode())
        self.fs.move(tmp, f"{self.base}/manifests/{batch_id}.json")

    def _clean(self, previous: dict[int, int], batch_id: int) -> None:
        from pyarrow import fs
        found = self._manifests()
        older = sorted(i for i in found if i < batch_id)
        needed = {*previous.items(), *self.manifest(batch_id + 1).items()}
        for n in {i.base_name for i in self.fs.get_file_info(fs.FileSelector(self.base))
                  if i.base_name.startswith("batch=")}:
            number = int(n.split("=")[1])
            names = [i.base_name for i in self.fs.get_file_info(fs.FileSelector(f"{self.base}/{n}"))
                     if i.base_name.startswith(_BUCKET)]
            dead = [b for b in names if (int(b.split("=")[1]), number) not in needed]
            if number < batch_id and len(dead) == len(names):
                self.fs.delete_dir(f"{self.base}/{n}")
            elif number < batch_id:
                for b in dead:
                    self.fs.delete_dir(f"{self.base}/{n}/{b}")
        for i in older[:-1]:
            self.fs.delete_file(found[i])


def upsert_sink(table: Table):
    """A ``foreachBatch`` function that keeps the newest row of every key; the
    batch must have one row per key, as an aggregation's update output has."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        path = f"{table.path}/changes"
        batch.write.mode("overwrite").parquet(path)  # the batch is computed once
        table.upsert(batch.sparkSession.read.schema(table.schema).parquet(path), batch_id)
    return sink
