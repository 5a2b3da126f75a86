"""Topic sources and sinks.

A topic is either a Kafka topic (``fmt="kafka"``, needs the Kafka connector on
the classpath) or its file twin: a folder of JSON lines, or of another format of
Spark's (``COMPACT``: compressed parquet for messages that hold payloads), with
the envelope columns ``key, value, topic, partition, offset, timestamp``.
Readers return the envelope in all cases, so every downstream operator is
format-agnostic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.schemas import ENVELOPE
from streamlens.session import written

# Upload routing: file type -> topic (S11); anything else goes to the last one.
UPLOAD_TOPICS = {"document": "uploaded_documents", "video": "uploaded_videos",
                 "image": "uploaded_images"}
UPLOAD_FALLBACK_TOPIC = "uploaded_files"
BATCH_FOLDER = "stream_batch"
COMPACT = {"fmt": "parquet", "options": {"compression": "zstd"}}  # a file topic that takes little disk


def topic_path(root: str, topic: str) -> str:
    """The folder of a file topic (named as a routed, partitioned write names it)."""
    return f"{root.rstrip('/')}/topic={topic}"


def read_topic(spark: SparkSession, topics: str | list[str], *, fmt: str = "json",
               root: str | None = None, stream: bool = True,
               bootstrap_servers: str | None = None, starting: str = "earliest",
               max_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Envelope rows of one or more topics, from the start (T5).

    ``max_per_trigger`` bounds a micro-batch: files per trigger for the file
    twin, offsets per trigger for Kafka (T9).
    """
    topics = [topics] if isinstance(topics, str) else list(topics)
    if fmt == "kafka":
        reader = spark.readStream if stream else spark.read
        r = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
             .option("subscribe", ",".join(topics)).option("startingOffsets", starting))
        if stream and max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        raw = r.load()
        return raw.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"),
                          "topic", "partition", "offset", "timestamp")
    if root is None:
        raise ValueError("file topics need a root folder")
    frames = []
    for t in topics:
        reader = spark.readStream if stream else spark.read
        r = reader.schema(ENVELOPE).format(fmt)
        if stream and max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        rows = r.load(topic_path(root, t)).withColumn("topic", F.coalesce("topic", F.lit(t)))
        frames.append(rows.select(*ENVELOPE.fieldNames()))
    return reduce(lambda a, b: a.unionByName(b), frames)


def to_envelope(records: DataFrame, topic: str | None = None, key: str | None = None,
                value: str = "value") -> DataFrame:
    """Shape ``key, value`` rows as envelope rows for a file topic."""
    cols = records.columns
    return records.select(
        (F.col(key) if key else (F.col("key") if "key" in cols else F.lit(None))).cast("string").alias("key"),
        F.col(value).cast("string").alias("value"),
        (F.lit(topic) if topic else F.col("topic")).alias("topic"),
        (F.col("partition") if "partition" in cols else F.lit(None)).cast("int").alias("partition"),
        (F.col("offset") if "offset" in cols else F.lit(None)).cast("long").alias("offset"),
        (F.col("timestamp") if "timestamp" in cols else F.current_timestamp()).cast("timestamp").alias("timestamp"),
    )


def write_topic(df: DataFrame, topic: str | None = None, *, fmt: str = "json",
                root: str | None = None, bootstrap_servers: str | None = None,
                options: dict | None = None, batch_id: int | None = None) -> None:
    """Batch write of ``key, value`` rows to a topic (S9).  With ``topic=None``
    a ``topic`` column routes each row (S11).

    ``batch_id`` names a micro-batch: the file topic keeps its rows in a folder
    of that name and replaces it, so a batch that is delivered twice is there
    once (Kafka appends: at-least-once).  ``options`` are those of the writer.
    """
    if fmt == "kafka":
        w = df.select("key", "value", *(["topic"] if topic is None else [])).write.format("kafka")
        w = w.option("kafka.bootstrap.servers", bootstrap_servers)
        if topic:
            w = w.option("topic", topic)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
        return
    env = to_envelope(df, topic)
    if batch_id is not None:
        if not topic:
            raise ValueError("a batch id needs one topic")
        env.write.mode("overwrite").format(fmt).options(**(options or {})).save(
            f"{topic_path(root, topic)}/{BATCH_FOLDER}={batch_id}")
    elif topic:
        env.write.mode("append").format(fmt).options(**(options or {})).save(topic_path(root, topic))
    else:
        # One folder per topic: a partitioned write keeps it to a single job.
        env.write.mode("append").partitionBy("topic").format(fmt).options(**(options or {})).save(root)


def read_batch(spark: SparkSession, root: str, topic: str, batch_id: int, fmt: str = "json") -> DataFrame:
    """The rows that ``write_topic`` wrote for one micro-batch."""
    return spark.read.schema(ENVELOPE).format(fmt).load(f"{topic_path(root, topic)}/{BATCH_FOLDER}={batch_id}")


def land_messages(messages: DataFrame, root: str, topic: str, *, fmt: str = "json",
                  options: dict | None = None) -> str:
    """Append all envelope rows to a file topic, with the parallelism they
    come in; returns the topic's folder."""
    path = topic_path(root, topic)
    messages.select(*ENVELOPE.fieldNames()).write.mode("append").format(fmt).options(**(options or {})).save(path)
    return path


def drop_messages(root: str, topic: str) -> None:
    """Delete the files of a file topic (as a broker's retention does) once the
    queries that read it have ended and committed what is there; they can go on
    with later messages."""
    from streamlens.sources.files import filesystem
    fs, base = filesystem(topic_path(root, topic))
    fs.delete_dir_contents(base, missing_dir_ok=True)


def make_folder(path: str) -> None:
    """Create a folder if it is not there."""
    from streamlens.sources.files import filesystem
    fs, base = filesystem(path)
    fs.create_dir(base, recursive=True)


OFFSET_BLOCK = 10_000
_OFFSETS = "topic string, landing string, partition int, block long, first_offset long, last_offset long, n long"


def land_offsets(messages: DataFrame, root: str, topic: str, block: int = OFFSET_BLOCK) -> str:
    """Append envelope rows to a topic that can be read by offsets.

    Files lie in ``landing=/partition=/block=`` folders (``block`` offsets each,
    sorted by offset), so a range of offsets is a range of folders.  What each
    folder holds goes to the small table ``_offsets`` last; a landing that fails
    before is not seen.  Rows without partition or offset are refused.
    """
    import uuid
    spark, landing = messages.sparkSession, uuid.uuid4().hex
    path = f"{root.rstrip('/')}/offsets-topic={topic}/landing={landing}"
    cols = [F.col(c) for c in ENVELOPE.fieldNames() if c not in ("topic", "partition", "offset")]
    checked = [F.coalesce(c, F.raise_error(F.lit(f"{topic}: a message without {c}")).cast(t)).alias(c)
               for c, t in (("partition", "int"), ("offset", "long"))]
    rows = messages.select(*cols, *checked).withColumn("block", F.floor(F.col("offset") / block).cast("long"))
    (rows.repartition("partition", "block").sortWithinPartitions("partition", "block", "offset")
     .write.partitionBy("partition", "block").parquet(path))
    landed = spark.read.schema("offset long, partition int, block long").parquet(path)  # one column of the new files
    stats = landed.groupBy("partition", "block").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count(F.lit(1)).alias("n"))
    (stats.select(F.lit(topic).alias("topic"), F.lit(landing).alias("landing"), "partition", "block", "first_offset",
                  "last_offset", "n").write.mode("append").parquet(f"{root.rstrip('/')}/_offsets_{topic}"))
    return path


def offset_blocks(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The folders of a topic that :func:`land_offsets` wrote, with their offsets."""
    return spark.read.schema(_OFFSETS).parquet(f"{root.rstrip('/')}/_offsets_{topic}")


def _read_blocks(spark: SparkSession, root: str, topic: str, blocks: list) -> DataFrame:
    base = f"{root.rstrip('/')}/offsets-topic={topic}"
    paths = [f"{base}/landing={b.landing}/partition={b.partition}/block={b.block}" for b in blocks]
    if not paths:
        return spark.createDataFrame([], ENVELOPE)
    rows = spark.read.option("basePath", base).schema(
        "key string, value string, timestamp timestamp, offset long, landing string, partition int, block long").parquet(*paths)
    return rows.withColumn("topic", F.lit(topic)).select(*ENVELOPE.fieldNames())


def read_offsets(spark: SparkSession, topic: str, start: dict[int, int], end: dict[int, int], *, fmt: str = "parquet",
                 root: str | None = None, bootstrap_servers: str | None = None) -> DataFrame:
    """Messages of a topic by partition from offset ``start`` up to, without,
    ``end``.  Only the files of the blocks that hold such offsets are read (the
    broker does the same for ``fmt="kafka"``); partitions not named are left out."""
    if fmt == "kafka":
        import json
        ranges = [json.dumps({topic: {str(p): o for p, o in r.items()}}) for r in (start, end)]
        raw = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
               .option("assign", json.dumps({topic: sorted(start)}))
               .option("startingOffsets", ranges[0]).option("endingOffsets", ranges[1]).load())
        return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                          "topic", "partition", "offset", "timestamp")
    if start.keys() != end.keys():
        raise ValueError("start and end must name the same partitions")
    inside, blocks = F.lit(False), F.lit(False)
    for p in start:
        here = F.col("partition") == p
        inside |= here & (F.col("offset") >= start[p]) & (F.col("offset") < end[p])
        blocks |= here & (F.col("last_offset") >= start[p]) & (F.col("first_offset") < end[p])
    # as many rows as folders that the range touches
    found = offset_blocks(spark, root, topic).where(blocks).collect()
    return _read_blocks(spark, root, topic, found).where(inside)


def read_first(spark: SparkSession, topics: list[str], n: int, root: str) -> DataFrame:
    """The files of each topic that hold its first ``n`` messages in (partition,
    offset) order; L1 (``operators.topics.first_messages``) cuts them to n.

    The statistics say how many messages precede a block, so as many blocks are
    opened as n messages need, whatever the size of the topic.
    """
    from pyspark.sql import Window
    frames = []
    for topic in topics:
        blocks = offset_blocks(spark, root, topic)
        sizes = blocks.groupBy("partition", "block").agg(F.sum("n").alias("n"))
        # one row per folder of a topic in this window; the limit keeps at most n + 1 of them
        w = Window.orderBy("partition", "block").rowsBetween(Window.unboundedPreceding, -1)
        first = sizes.orderBy("partition", "block").limit(n + 1)
        needed = first.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).where(F.col("before") < n)
        found = blocks.join(needed.select("partition", "block"), ["partition", "block"]).collect()
        frames.append(_read_blocks(spark, root, topic, found))
    return reduce(lambda a, b: a.unionByName(b), frames)


def time_slices(messages: DataFrame, n: int, order_col: str = "timestamp") -> list[DataFrame]:
    """The messages in ``n`` parts of equal time range, oldest first, for a
    replay in time order (land one, run the stream, land the next).

    The messages are written once; the parts are filters on the written table.
    Rows without a time belong to the last part.
    """
    kept = written(messages.select(*ENVELOPE.fieldNames()), "slices")
    t = F.unix_micros(F.col(order_col))
    lo, hi = kept.agg(F.min(t), F.max(t)).first()
    if n <= 1 or lo is None:
        return [kept] + [kept.limit(0)] * (n - 1)
    at = [lo + (hi - lo + 1) * i // n for i in range(1, n)]
    bounds = [F.timestamp_micros(F.lit(x)) for x in at]
    c = F.col(order_col)
    parts = [kept.where(c < bounds[0])]
    parts += [kept.where((c >= x) & (c < y)) for x, y in zip(bounds, bounds[1:])]
    return parts + [kept.where((c >= bounds[-1]) | c.isNull())]


def time_shares(messages: DataFrame, n: int, order_col: str = "timestamp") -> list[DataFrame]:
    """The messages in ``n`` parts of about equal size, oldest first, as filters
    on the messages themselves: :func:`time_slices` for those that are cheap to
    compute again and too large to be written once more.

    Messages of one time are in one part; those without a time in the last one.
    """
    t = F.unix_micros(F.col(order_col))
    at = messages.agg(F.percentile_approx(t, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else None
    if at is None:
        return [messages] + [messages.limit(0)] * (n - 1)
    bounds = [F.timestamp_micros(F.lit(x)) for x in at]
    c = F.col(order_col)
    parts = [messages.where(c < bounds[0])]
    parts += [messages.where((c >= x) & (c < y)) for x, y in zip(bounds, bounds[1:])]
    return parts + [messages.where((c >= bounds[-1]) | c.isNull())]


def upload_topic(file_type_col) -> "F.Column":
    out = F.lit(UPLOAD_FALLBACK_TOPIC)
    for t, topic in reversed(list(UPLOAD_TOPICS.items())):
        out = F.when(file_type_col == t, F.lit(topic)).otherwise(out)
    return out


def stream_to_topic(stream: DataFrame, topic: str, *, checkpoint: str, fmt: str = "json",
                    root: str | None = None, bootstrap_servers: str | None = None,
                    available_now: bool = False, processing_time: str | None = None,
                    output_mode: str = "append", options: dict | None = None):
    """Streaming sink of ``key, value`` rows to a topic.

    Kafka gives at-least-once delivery; the file twin is exactly-once through
    the file sink's commit log.  Returns the started query.
    """
    if fmt == "kafka":
        w = (stream.select("key", "value").writeStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic))
    else:
        w = (to_envelope(stream, topic).writeStream.format(fmt)
             .option("path", topic_path(root, topic)))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
