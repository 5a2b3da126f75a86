"""Lookup tables that change while a stream runs.

A lookup is a folder of versions.  :meth:`Lookup.publish` writes a version whole
and then names it in a manifest, by one rename, so a reader sees a version or
does not.  Every micro-batch is joined with the version that is newest when the
batch first runs; the batch's version is noted before its rows are written, so
a batch that is delivered again gives the same rows, whatever was published in
between.  A changed row changes later batches only.

The join is a left join without a hint: Spark broadcasts a version whose files
are measured below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles both sides, where AQE splits a hot key's rows.  Keys are distinct and
not NULL (checked on publishing), so no record is repeated; a record whose key
is NULL or not in the table gets the defaults.  One process publishes at a
time.  Versions are kept: a noted version must stay as long as its batch can
be delivered again.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.sources.files import filesystem
from streamlens.streaming.runner import BATCH_ID


def _put(path: str, name: int, state: dict) -> None:
    """Write ``path/name.json`` whole, by a rename."""
    fs, base = filesystem(path)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/.{name}.json") as f:
        f.write(json.dumps(state).encode())
    fs.move(f"{base}/.{name}.json", f"{base}/{name}.json")


def _names(path: str) -> list[int]:
    from pyarrow import fs as afs
    fs, base = filesystem(path)
    found = fs.get_file_info(afs.FileSelector(base, allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found
                  if f.base_name.endswith(".json") and not f.base_name.startswith("."))


def _get(path: str, name: int) -> dict:
    fs, base = filesystem(path)
    with fs.open_input_stream(f"{base}/{name}.json") as f:
        return json.loads(f.read())


class Lookup:
    """A versioned lookup table below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str):
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def publish(self, rows: DataFrame) -> int:
        """Write ``rows`` as the next version and return its number (from 1).
        Raises ValueError, and publishes nothing, if a key is NULL or repeated."""
        version = (self.newest() or 0) + 1
        folder = f"{self.path}/version={version}"
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(folder)
        k = F.col(f"`{self.key}`")
        bad = self._files(version).groupBy(k).count().where(k.isNull() | (F.col("count") > 1)).head()
        if bad is not None:
            raise ValueError(f"key {bad[0]!r} is NULL or repeated")
        _put(f"{self.path}/manifests", version, {"version": version})
        return version

    def newest(self) -> int | None:
        names = _names(f"{self.path}/manifests")
        return names[-1] if names else None

    def _files(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={version}")

    def read(self, version: int | None) -> DataFrame:
        """The rows of a version; none if nothing was published yet."""
        return self.spark.createDataFrame([], self.schema) if version is None else self._files(version)


def attach(records: DataFrame, rows: DataFrame, record_key: str, key: str, defaults: dict) -> DataFrame:
    """``records`` plus the columns of ``rows`` but its key; ``defaults`` (column
    -> value) where the key has no row.  Columns of ``records`` with the same
    names are replaced."""
    values = [c for c in rows.columns if c != key]
    kept = records.drop(*values)
    found = rows.select(F.col(f"`{key}`").alias("_lookup_key"), F.lit(True).alias("_lookup_hit"),
                        *[F.col(f"`{c}`").alias(f"_lookup_{c}") for c in values])

    def value(c: str) -> Column:
        return F.when(F.col("_lookup_hit"), F.col(f"_lookup_{c}")).otherwise(F.lit(defaults.get(c)).cast(rows.schema[c].dataType))

    return (kept.join(found, F.col(f"`{record_key}`") == F.col("_lookup_key"), "left")
            .select(*[F.col(f"`{c}`") for c in kept.columns], *[value(c).alias(c) for c in values]))


def batch_version(lookup: Lookup, out: str, batch_id: int) -> int | None:
    """The version that a micro-batch uses: the one noted for it, else the newest,
    which is noted."""
    notes = f"{out.rstrip('/')}/_lookup_versions"
    if batch_id not in _names(notes):
        _put(notes, batch_id, {"version": lookup.newest()})
    return _get(notes, batch_id)["version"]


def lookup_sink(lookup: Lookup, out: str, record_key: str, defaults: dict | None = None):
    """A ``foreachBatch`` function: the batch's records with the lookup's columns
    and ``lookup_version``, in a folder per batch below ``out``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        version = batch_version(lookup, out, batch_id)
        rows = attach(batch, lookup.read(version), record_key, lookup.key, defaults or {})
        (rows.withColumn("lookup_version", F.lit(version).cast("int"))
         .write.mode("overwrite").parquet(f"{out}/{BATCH_ID}={batch_id}"))
    return sink
