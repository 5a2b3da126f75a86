"""Streaming forms of the three jobs.

Each function takes a streaming frame of envelope rows (from
:func:`streamlens.sources.io.read_topic`) and returns a streaming frame; the
same operators as the batch path are used, plus a watermark on the event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.operators import aggregates as agg
from streamlens.operators import files as fo
from streamlens.operators import running as run
from streamlens.operators import transactions as to
from streamlens.operators.parse import REJECT, parse_messages
from streamlens.plans import jobs
from streamlens.sources import io
from streamlens.streaming import runner, running_batches

EVENT_TS = "event_ts"


def with_event_time(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """A TIMESTAMP copy of ``event_time`` with a watermark."""
    return (df.withColumn(EVENT_TS, F.col("event_time").cast("timestamp"))
              .withWatermark(EVENT_TS, delay))


def processing_time(df: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Processing-time windows (T1): the window column is the arrival clock.
    The clock only moves on, so the watermark drops no row; it lets the state
    of past windows go."""
    return df.withColumn(EVENT_TS, F.current_timestamp()).withWatermark(EVENT_TS, delay)


def _ntz_windows(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
              .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


# Only these members are extracted from the messages of each path.
WINDOW_FIELDS = {
    "transactions": ["category", "amount", "event_time"],
    "video_frames": ["frame_data", "frame_width", "frame_height", "frame_size_bytes", "source", "event_time"],
    "uploaded_files": ["file_type", "file_size", "file_content", "metadata", "event_time"],
}
WINDOWED = {
    "transactions": (jobs.processed_transactions, agg.category_window, "category"),
    "video_frames": (jobs.processed_frames, agg.resolution_window, "resolution_category"),
    "uploaded_files": (jobs.processed_files, agg.size_window, "size_category"),
}
TOTAL_FIELDS = {
    "transactions": ["user_id", "category", "amount", "event_time"],
    "video_frames": ["frame_data", "source", "frame_width", "frame_height", "frame_size_bytes", "event_time"],
    "uploaded_files": ["file_type", "file_size", "file_content", "metadata", "event_time"],
}
RUNNING_FIELDS = {
    "transactions": ["transaction_id", *TOTAL_FIELDS["transactions"]],
    "video_frames": ["frame_id", *TOTAL_FIELDS["video_frames"]],
    "uploaded_files": ["file_id", *TOTAL_FIELDS["uploaded_files"]],
}
TOTALS = {
    "transactions": (jobs.processed_transactions, agg.user_totals, "user_id"),
    "video_frames": (jobs.processed_frames, agg.source_totals, "source"),
    "uploaded_files": (jobs.processed_files, agg.file_type_totals, "file_type"),
}


def windowed(messages: DataFrame | list[DataFrame], kind: str, length: str = "30 seconds",
             delay: str = "1 hour", by_arrival: bool = False) -> DataFrame:
    """W1-W3 on a stream: event time with a watermark, or arrival time.

    Several topics (a list of streams) each get their own watermark before
    the union; Spark then holds the global watermark at the slowest topic
    (``multipleWatermarkPolicy=min``), so one topic running ahead in event
    time does not make another topic's rows late.
    """
    process, window_fn, _ = WINDOWED[kind]
    parts = messages if isinstance(messages, list) else [messages]
    fields = WINDOW_FIELDS[kind]
    recs = [processing_time(process(m, fields=fields)) if by_arrival
            else with_event_time(process(m, fields=fields, require_time=True), delay)
            for m in parts]
    return window_fn(fo.union_all(*recs), length, time_col=EVENT_TS)


# What the fold W4 averages, per kind: the outputs' names and measures, and the record id.
PAIRWISE = {
    "video_frames": ({"pairwise_avg_width": "frame_width", "pairwise_avg_height": "frame_height"}, "frame_id",
                     "analysis.resolution_category"),
    "uploaded_files": ({"pairwise_avg_size_bytes": "file_size"}, "file_id", "analysis.size_category"),
}


def pairwise_windowed(messages: DataFrame | list[DataFrame], kind: str, length: str = "30 seconds",
                      delay: str = "1 hour", chunk: str = "1 second") -> DataFrame:
    """W4 on a stream (``append`` mode): the order-dependent fold per class and
    event-time window; rows may arrive in any order inside the watermark."""
    process, _, key_name = WINDOWED[kind]
    values, id_col, key = PAIRWISE[kind]
    parts = messages if isinstance(messages, list) else [messages]
    recs = [with_event_time(process(m, fields=[id_col, *WINDOW_FIELDS[kind]], require_time=True), delay) for m in parts]
    merged = recs[0]
    for r in recs[1:]:
        merged = merged.unionByName(r)
    return agg.pairwise_avg_closed(merged, F.coalesce(F.col(key), F.lit("unknown")), key_name, values, id_col, length,
                                   EVENT_TS, chunk)


RECORD_ID = {"transactions": "transaction_id", "video_frames": "frame_id", "uploaded_files": "file_id"}


def delivered_once(messages: DataFrame, kind: str, fields: list[str], delay: str = "1 hour") -> DataFrame:
    """Processed records of a stream whose producer may send a message again
    (S9 / S6: a retry after a lost acknowledgement), each record id once.

    An id is remembered until the watermark is ``delay`` behind its event time,
    so the state is bounded by the rate, not by the stream's age; a copy that
    comes later than that is late itself and dropped by the watermark.
    """
    id_col = RECORD_ID[kind]
    recs = WINDOWED[kind][0](messages, fields=list(dict.fromkeys([id_col, *fields])), require_time=True)
    return with_event_time(recs, delay).dropDuplicatesWithinWatermark([id_col])


def windowed_once(messages: DataFrame, kind: str, length: str = "30 seconds", delay: str = "1 hour") -> DataFrame:
    """W1-W3 (``append`` mode) over :func:`delivered_once`."""
    return WINDOWED[kind][1](delivered_once(messages, kind, WINDOW_FIELDS[kind], delay), length, time_col=EVENT_TS)


def window_keys(kind: str) -> list[str]:
    return ["window_start", "window_end", WINDOWED[kind][2]]


def totals(messages: DataFrame, kind: str) -> DataFrame:
    """A1-A3 on a stream (``update`` mode: one changed row per key and batch)."""
    process, totals_fn, _ = TOTALS[kind]
    return totals_fn(process(messages, fields=TOTAL_FIELDS[kind]))


def running_input(messages: DataFrame, kind: str) -> DataFrame:
    """The narrowed records that ``running_batches.running_sink`` takes; records
    without a readable time are rejected by the parser."""
    return run.narrowed(TOTALS[kind][0](messages, fields=RUNNING_FIELDS[kind], require_time=True), kind)


def run_running(messages: DataFrame, kind: str, *, out: str, state: str, checkpoint: str,
                ttl_ms: int | None = None) -> None:
    """R1-R3 on a stream: process what is available now."""
    runner.finish(runner.start_batches(running_input(messages, kind),
                                       running_batches.running_sink(kind, out, state, ttl_ms), checkpoint=checkpoint))


def fanout_sink(root: str, very_high: float = 500.0):
    """One micro-batch of processed transactions feeds two topics.

    The rows go to ``processed_transactions`` and those with an amount above
    ``very_high`` to ``high_value_transactions``.  The second leg is filtered
    from the written first one, so the batch is computed once, and both legs
    replace the batch's folder when a batch is delivered again.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        cols = to.RECORD_COLS + ["original_amount", "discount_applied", "final_amount"]
        io.write_topic(to.to_json_value(batch, cols, key="user_id"), "processed_transactions",
                       root=root, batch_id=batch_id)
        done = io.read_batch(batch.sparkSession, root, "processed_transactions", batch_id)
        amount = F.get_json_object("value", "$.amount").cast("double")
        io.write_topic(done.where(amount > very_high), "high_value_transactions", root=root, batch_id=batch_id)
    return sink


def json_topic_sink(stream: DataFrame, root: str, topic: str, checkpoint: str):
    """A streaming ``key, value`` frame appended to a file topic."""
    return io.stream_to_topic(stream, topic, checkpoint=checkpoint, root=root,
                              available_now=True)


# --------------------------------------------------------------------------
# One parse for all branches
# --------------------------------------------------------------------------

def landed_rows(messages: list[DataFrame], kind: str) -> DataFrame:
    """Parsed messages for the landed table: the record columns, ``topic``,
    ``accepted``, and for rejected ones the reason and the raw value."""
    parsed = fo.union_all(*[parse_messages(m, kind, keep=["topic"]) for m in messages])
    ok = F.col(REJECT).isNull()
    return parsed.withColumns({"raw_value": F.when(~ok, F.col("raw_value")), "accepted": ok})


def start_landing(messages: list[DataFrame], kind: str, *, root: str, checkpoint: str,
                  available_now: bool = True, processing_time: str | None = None):
    """Parse the topics of a job once and append the rows to a table below
    ``root``, partitioned by ``accepted`` and ``topic``.

    The record columns are typed, so a branch that reads the table
    (:func:`read_landed`) scans only its members and parses nothing, and the
    rejected messages lie in folders of their own.  The file sink's commit log
    makes a row visible once.
    """
    w = (landed_rows(messages, kind).writeStream.format("parquet").partitionBy("accepted", "topic")
         .option("checkpointLocation", checkpoint).option("path", root).outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def _landed_schema(spark: SparkSession, kind: str):
    empty = spark.createDataFrame([], "value string, topic string")
    return landed_rows([empty], kind).schema


def read_landed(spark: SparkSession, root: str, kind: str, topic: str | None = None,
                max_per_trigger: int | None = None) -> DataFrame:
    """A stream of the accepted records of a landed table (of one topic)."""
    r = spark.readStream.schema(_landed_schema(spark, kind))
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    rows = r.parquet(root).where("accepted").drop("accepted", "raw_value", REJECT)
    return rows if topic is None else rows.where(F.col("topic") == topic)


def landed_quarantine(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The rejected messages of a landed table."""
    return (spark.read.schema(_landed_schema(spark, kind)).parquet(root).where("not accepted")
            .select("topic", "raw_value", REJECT))


def landed_branches(records: list[DataFrame], kind: str, window: str = "30 seconds",
                    delay: str = "1 hour") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three branches of a job over landed records (one stream per topic):
    processed records, the narrowed input of the running statistics, and the
    window summaries.  Records without a readable time are in the first only."""
    enrich, (_, window_fn, _) = jobs.ENRICHED[kind], WINDOWED[kind]
    timed = [enrich(r.where("event_time is not null")) for r in records]
    windows = window_fn(fo.union_all(*[with_event_time(r, delay) for r in timed]), window, time_col=EVENT_TS)
    return enrich(fo.union_all(*records)), run.narrowed(fo.union_all(*timed), kind), windows


# Topic names of each job: source topics, processed records, running aggregations.
JOB_TOPICS = {
    "transactions": (["transactions"], "processed_transactions", "user_aggregations"),
    "video_frames": (["video_frames"], "processed_video_frames", "video_source_aggregations"),
    "uploaded_files": (list(io.UPLOAD_TOPICS.values()), "processed_files",
                       "file_type_aggregations"),
}
_RUNNING_OUT = {
    "transactions": ["transaction_id", "user_id", "total_spent", "transaction_count",
                     "last_updated"],
    "video_frames": ["frame_id", "source", "total_frames", "total_size_bytes", "avg_width",
                     "avg_height", "last_updated"],
    "uploaded_files": ["file_id", "file_type", "total_files", "total_size_bytes",
                       "avg_size_bytes", "largest_file_size", "smallest_file_size",
                       "last_updated"],
}


def start_job(spark: SparkSession, kind: str, *, checkpoint_root: str,
              source: dict, sink: dict, window: str = "30 seconds", delay: str = "1 hour",
              windows_out: str | None = None, available_now: bool = False,
              processing_time: str | None = None, max_per_trigger: int | None = None,
              ttl_ms: int | None = None, landed: str | None = None) -> list:
    """Start one of the three jobs as three streaming queries and return them.

    * processed records -> ``processed_*`` topic (JSON value, keyed like the
      source);
    * one running-statistics row per record -> ``*_aggregations`` topic;
    * tumbling-window summaries per class -> parquet at ``windows_out`` through
      the update log (or the console when ``windows_out`` is None).

    ``source`` / ``sink`` are keyword options of :func:`io.read_topic` /
    :func:`io.stream_to_topic` (``fmt``, ``root``, ``bootstrap_servers``).
    ``max_per_trigger`` bounds a micro-batch in the unit of the source: offsets
    for Kafka, files for a file topic.

    The source is read and parsed three times, once per query, unless ``landed``
    names a folder: then a first query parses it once into a table there
    (:func:`start_landing`) and the three read their columns from that, with
    ``available_now`` after it has ended.  Either way each query has a
    checkpoint, a trigger pace and a failure domain of its own, as the three
    branches of the original job have.
    """
    in_topics, processed_topic, agg_topic = JOB_TOPICS[kind]
    key = {"transactions": "user_id", "uploaded_files": "filename"}.get(kind)
    trig = {"available_now": available_now, "processing_time": processing_time}
    streams = [io.read_topic(spark, t, max_per_trigger=max_per_trigger, **source)
               for t in in_topics]
    queries = []
    if landed:
        queries.append(start_landing(streams, kind, root=landed, checkpoint=f"{checkpoint_root}/{kind}-landing", **trig))
        if available_now:
            runner.finish(queries[0])
        else:
            io.make_folder(landed)  # a file source needs its folder
        records = [read_landed(spark, landed, kind, t, max_per_trigger) for t in in_topics]
        processed, running_rows, windows = landed_branches(records, kind, window, delay)
    else:
        merged = fo.union_all(*streams)
        processed, running_rows = TOTALS[kind][0](merged), running_input(merged, kind)
        windows = windowed(streams, kind, window, delay)
    queries.append(io.stream_to_topic(to.to_json_value(processed, jobs.PROCESSED_COLUMNS[kind], key=key),
                                      processed_topic, checkpoint=f"{checkpoint_root}/{kind}-processed",
                                      **sink, **trig))

    def publish(rows: DataFrame, batch_id: int) -> None:
        cols = _RUNNING_OUT[kind]
        io.write_topic(to.to_json_value(rows, cols, key=cols[1]), agg_topic, batch_id=batch_id, **sink)

    queries.append(runner.start_batches(
        running_rows,
        running_batches.running_sink(kind, f"{checkpoint_root}/{kind}-running-rows",
                                     f"{checkpoint_root}/{kind}-running-state", ttl_ms, publish),
        checkpoint=f"{checkpoint_root}/{kind}-running", **trig))
    queries.append(runner.start(windows, "update" if windows_out else "console",
                                out=windows_out, checkpoint=f"{checkpoint_root}/{kind}-windows", **trig))
    return queries


__all__ = ["with_event_time", "processing_time", "windowed", "totals", "running_input", "run_running",
           "fanout_sink", "json_topic_sink", "window_keys", "start_landing", "read_landed", "landed_quarantine",
           "landed_branches", "start_job"]
