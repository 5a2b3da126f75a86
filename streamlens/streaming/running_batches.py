"""Per-record running statistics on streams (R1-R3 stream form, T4).

Every micro-batch is scanned like a static table (``operators.running``: hot
keys split by time chunk, no Python), and what earlier batches contributed is
joined in from the keyed state: one row per key with its statistics so far.
Within a micro-batch the rows of a key are put in (time, id) order; across
batches arrival order holds, as in a keyed stream processor.

The state is an upsert table in the shared folder (``streaming.upsert``): one
row per key in hash buckets.  A batch reads and rewrites only the buckets that
its keys fall in, and superseded files are removed, so keys that are idle cost a
batch nothing but their bucket neighbours.  Output and state of a batch are
named by the batch id and replaced when a batch is delivered again, so a replay
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.operators import running as run
from streamlens.streaming.upsert import Table

BUCKETS = 32
BATCH = "stream_batch"
_SEEN = "seen_ms"


def _last_rows(rows: DataFrame, kind: str) -> DataFrame:
    """The last row per key of a batch's running rows, as state rows."""
    spec = run.SPECS[kind]
    values = [*spec["aggs"], _SEEN]
    counter = next(iter(spec["aggs"]))  # grows within a batch
    best = rows.groupBy(spec["key"]).agg(F.max_by(F.struct(*values), F.col(counter)).alias("s"))
    return best.select(spec["key"], *[F.col(f"s.{v}").alias(v) for v in values])


def running_sink(kind: str, out: str, state: str, ttl_ms: int | None = None,
                 publish: Callable[[DataFrame, int], None] | None = None, buckets: int = BUCKETS):
    """A ``foreachBatch`` function over narrowed records (``run.narrowed``).

    Running rows go to ``out`` (read them with :func:`rows`), and through
    ``publish(finished_rows, batch_id)`` to wherever else they are wanted.
    ``ttl_ms`` forgets keys idle for that long, in processing time; their
    statistics then start again, and their rows go when their bucket is next
    rewritten.  ``buckets`` is fixed by the first batch: a batch that touches few
    keys reads that share of the state.
    """
    spec = run.SPECS[kind]
    key, aggs = spec["key"], spec["aggs"]

    def sink(batch: DataFrame, batch_id: int) -> None:
        import time
        spark, now_ms = batch.sparkSession, int(time.time() * 1000)
        # the narrow rows are parsed once: their keys prune the state, then they are scanned
        batch.write.mode("overwrite").parquet(f"{state}/batch")
        narrow = spark.read.schema(batch.schema).parquet(f"{state}/batch")
        cur = run.in_order(narrow, kind)
        held = _last_rows(cur.withColumn(_SEEN, F.lit(now_ms)), kind).schema
        table = Table(spark, f"{state}/table", held, [key], buckets)
        fresh = F.lit(True) if ttl_ms is None else F.col(_SEEN) >= F.lit(now_ms - ttl_ms)
        prev = table.read_touched(table.touched(narrow.select(key)), batch_id).where(fresh)
        before = prev.select(F.col(key).alias("_k"), *[F.col(n).alias(f"_p_{n}") for n in aggs])
        cur = cur.join(before, F.col(key).eqNullSafe(F.col("_k")), "left")
        for n, (how, _) in aggs.items():
            cur = cur.withColumn(n, run.combine(how, F.col(f"_p_{n}"), F.col(n)))
        cur = cur.drop("_k", *[f"_p_{n}" for n in aggs])
        path = f"{out}/{BATCH}={batch_id}"
        cur.write.mode("overwrite").parquet(path)
        done = spark.read.schema(cur.schema).parquet(path)
        _last_rows(done.withColumn(_SEEN, F.lit(now_ms)), kind).write.mode("overwrite").parquet(f"{state}/changes")
        table.upsert(spark.read.schema(held).parquet(f"{state}/changes"), batch_id, fresh)
        if publish:
            publish(run.finished(done, kind), batch_id)
    return sink


def rows(spark: SparkSession, kind: str, out: str) -> DataFrame:
    """All running rows written so far."""
    return run.finished(spark.read.parquet(out).drop(BATCH), kind)
