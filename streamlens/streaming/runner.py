"""Run a streaming query to the end of its input and return the result as a
static DataFrame (T2, T6-T9).

* ``append``: a parquet file sink (exactly-once through its commit log).
* ``update``: ``foreachBatch`` writes every batch's changed rows under the
  batch id to a parquet log; the result is the latest row per key, taken with
  ``max_by`` (a partial aggregation, so hot keys are combined map-side).  A
  batch has a folder of its own and replaces it when it is delivered again.
* ``upsert``: ``foreachBatch`` keeps a bucketed table of one row per key
  (``streaming.upsert``), which is read without a reduction.

Checkpoints and outputs live below ``spark.checkpoint.dir``; a restart with the
same ``checkpoint`` continues where the last run stopped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.session import scratch_path
from streamlens.streaming import upsert

BATCH_ID = "stream_batch"


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # nothing written yet
            return spark.createDataFrame([], schema)
        raise


def start(stream: DataFrame, mode: str = "append", *, out: str | None = None, checkpoint: str,
          available_now: bool = True, processing_time: str | None = None, keys: list[str] | None = None):
    """Start the sink of this module on ``stream`` and return the query.

    ``console`` prints every batch's changed rows (S8) with the same triggers.
    """
    w = stream.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if mode == "append":
        return w.outputMode("append").format("parquet").option("path", out).start()
    if mode in ("update", "complete"):
        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/{BATCH_ID}={batch_id}")
        return w.outputMode(mode).foreachBatch(sink).start()
    if mode == "upsert":
        table = upsert.Table(stream.sparkSession, out, stream.schema, keys)
        return w.outputMode("update").foreachBatch(upsert.upsert_sink(table)).start()
    if mode == "console":
        return w.outputMode("update").format("console").option("truncate", "false").start()
    raise ValueError(mode)


def start_batches(stream: DataFrame, sink, *, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None):
    """Start a ``foreachBatch`` function (which must be idempotent by batch id)."""
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


class Stopped(TimeoutError):
    """A run was stopped at its time limit; ``result`` is what it had by then."""

    def __init__(self, name: str, timeout_s: float, result: DataFrame):
        super().__init__(f"{name} stopped after {timeout_s} s with part of its input processed")
        self.result = result


def finish(q, timeout_s: float | None = None) -> bool:
    """Wait for a query; False when it had to be stopped at the time limit (L2)."""
    ended = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
    if not ended:
        q.stop()
    if q.exception() is not None:
        raise q.exception()
    return ended


def latest_per_key(log: DataFrame, keys: list[str]) -> DataFrame:
    """The row with the highest batch id per key of an update log."""
    cols = [c for c in log.columns if c not in keys and c != BATCH_ID]
    if not cols:
        return log.select(*keys).distinct()
    best = log.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(BATCH_ID)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def run_to_end(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append",
               keys: list[str] | None = None, checkpoint: str | None = None,
               out: str | None = None, timeout_s: float | None = None) -> DataFrame:
    """Process everything available now, then return the static result.

    ``timeout_s`` stops a run that takes longer and raises :class:`Stopped`,
    which holds the partial result, so it is never taken for the whole.
    """
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    out = out or scratch_path(spark, f"{name}-out")
    q = start(stream, mode, out=out, checkpoint=checkpoint, keys=keys)
    ended = finish(q, timeout_s)
    res = result(spark, stream, mode, out, keys)
    if not ended:
        raise Stopped(name, timeout_s, res)
    return res


def result(spark: SparkSession, stream: DataFrame, mode: str, out: str,
           keys: list[str] | None = None) -> DataFrame:
    if mode == "append":
        return _read_or_empty(spark, out, stream.schema)
    if mode == "upsert":
        return upsert.Table(spark, out, stream.schema, keys).read()
    log = _read_or_empty(spark, out, T.StructType([*stream.schema.fields, T.StructField(BATCH_ID, T.IntegerType())]))
    return latest_per_key(log, keys) if keys else log.drop(BATCH_ID)
