"""Adapters from the driver's tables to the three record streams.

The rules are those of FIXTURES.md section 2: every record is computed from one
row of ``events``, ``documents``, ``pages`` or ``conversations`` with built-in
expressions, so an adapter is a narrow projection that Spark pipelines into the
scan (no shuffle, only the needed columns are read).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from streamlens.functions.columns import (b64encode, case_map, iso_text,
                                          md5_hex, mime_type)

# ---------------------------------------------------------------------------
# Fixed adapter values (FIXTURES.md section 2).
# ---------------------------------------------------------------------------
PRODUCTS = ["kettle", "lamp", "bicycle", "violin", "tent", "novel", "scarf", "desk"]
EVENT_CATEGORY = {"purchase": "electronics", "click": "books", "view": "clothing"}
PAYMENTS = ["card", "transfer", "voucher", "coins"]
FRAME_SOURCES = ["webcam", "video_file", "sample_generator", "drone"]
FRAME_SIZES = [(320, 240), (640, 480), (1280, 720), (1920, 1080), (1080, 1920),
               (800, 800), (640, 360)]
FILE_SIZES = [(640, 480), (1280, 720), (1920, 1080)]
VIDEO_FPS = [24.0, 30.0, 0.0]
FILE_SIZE_FACTOR = 8192
EPOCH = "2024-01-01 00:00:00"
UPLOAD_STEP_SECONDS = 7
PARTITIONS = 3
LARGE_EVERY, LARGE_FACTOR = 40, 8  # every 40th event has eight times its amount, so that some exceed 500
# ---------------------------------------------------------------------------
UPLOADED_FILE_FIELDS = ("file_id", "filename", "file_type", "file_size", "file_hash",
                        "upload_timestamp", "file_content", "metadata")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Split sizes follow ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(idx: Column, values: list) -> Column:
    """``values[idx]`` for a small literal list (last entry = else branch)."""
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(idx == i, F.lit(values[i])).otherwise(out)
    return out


def _seconds_after_epoch(n: Column) -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=n.cast("long"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Transaction records, one per event; ``_id`` and ``event_time`` kept."""
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id")
    return events.select(
        F.concat(F.lit("txn_"), eid.cast("string")).alias("transaction_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        _pick(k % 8, PRODUCTS).alias("product"),
        case_map("event_type", EVENT_CATEGORY, "accessories").alias("category"),
        F.when(eid % LARGE_EVERY == 0, F.col("value") * LARGE_FACTOR).otherwise(F.col("value")).cast("double").alias("amount"),
        (eid % 5 + 1).cast("int").alias("quantity"),
        _pick(eid % 4, PAYMENTS).alias("payment_method"),
        iso_text("ts").alias("timestamp"),
        F.concat(F.lit("city_"), (k % 50 + 1).cast("string")).alias("location"),
        eid.alias("_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_time"),
    )


def frames_from_documents(documents: DataFrame) -> DataFrame:
    did = F.col("doc_id")
    payload = b64encode(F.encode("text", "UTF-8"))
    widths = [w for w, _ in FRAME_SIZES]
    heights = [h for _, h in FRAME_SIZES]
    t = _seconds_after_epoch(did)
    return documents.select(
        F.concat(F.lit("frame_"), did.cast("string")).alias("frame_id"),
        iso_text(t).alias("timestamp"),
        _pick(did % 4, FRAME_SOURCES).alias("source"),
        payload.alias("frame_data"),
        _pick(did % 7, widths).cast("int").alias("frame_width"),
        _pick(did % 7, heights).cast("int").alias("frame_height"),
        F.lit(3).alias("frame_channels"),
        F.length(payload).cast("long").alias("frame_size_bytes"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        did.alias("_id"),
        t.alias("event_time"),
    )


def _file_record(kind: str, ident: Column, name: Column, text: Column, meta: Column,
                 order_no: Column) -> list[Column]:
    t = _seconds_after_epoch(order_no * UPLOAD_STEP_SECONDS)
    return [
        F.concat(F.lit(kind + "_"), ident).alias("file_id"),
        name.alias("filename"),
        F.lit(kind).alias("file_type"),
        (F.octet_length(text).cast("long") * FILE_SIZE_FACTOR).alias("file_size"),
        md5_hex(text).alias("file_hash"),
        iso_text(t).alias("upload_timestamp"),
        b64encode(F.encode(text, "UTF-8")).alias("file_content"),
        meta.alias("metadata"),
        order_no.cast("long").alias("_id"),
        t.alias("event_time"),
    ]


def _meta(**members) -> Column:
    from streamlens.schemas import FILE_METADATA
    cols = []
    for f in FILE_METADATA.fields:
        c = members.get(f.name)
        cols.append((c if c is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def documents_as_files(documents: DataFrame) -> DataFrame:
    did = F.col("doc_id")
    name = F.concat(F.lit("doc_"), did.cast("string"), F.lit(".txt"))
    meta = _meta(text_content=F.col("text"), mime_type=mime_type(name))
    return documents.select(*_file_record("document", did.cast("string"), name,
                                          F.col("text"), meta, did))


def pages_as_files(pages: DataFrame) -> DataFrame:
    pid = F.col("page_id")
    name = F.concat(F.lit("page_"), pid.cast("string"), F.lit(".png"))
    w = _pick(pid % 3, [a for a, _ in FILE_SIZES])
    h = _pick(pid % 3, [b for _, b in FILE_SIZES])
    ch = F.when(pid % 5 == 0, F.lit(1)).otherwise(F.lit(3))
    meta = _meta(width=w, height=h, channels=ch, total_pixels=w.cast("long") * h,
                 mime_type=mime_type(name))
    return pages.select(*_file_record("image", pid.cast("string"), name,
                                      F.col("html"), meta, pid))


def conversations_as_files(conversations: DataFrame) -> DataFrame:
    cid, turn = F.col("conv_id"), F.col("turn")
    ident = F.concat(cid.cast("string"), F.lit("_"), turn.cast("string"))
    name = F.concat(F.lit("conv_"), ident, F.lit(".mp4"))
    fps = _pick(turn % 3, VIDEO_FPS)
    frames = (turn + 1) * 300
    w = _pick(cid % 3, [a for a, _ in FILE_SIZES])
    h = _pick(cid % 3, [b for _, b in FILE_SIZES])
    dur = F.when(fps > 0, frames.cast("double") / fps).otherwise(F.lit(0.0))
    meta = _meta(fps=fps, frame_count=frames, width=w, height=h, duration=dur,
                 mime_type=mime_type(name))
    return conversations.select(*_file_record("video", ident, name, F.col("text"),
                                              meta, cid * 100 + turn))


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(table(spark, sf_dir, "events"))


def load_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames_from_documents(table(spark, sf_dir, "documents"))


def load_file_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Uploaded-file records per topic, as the upload step routes them."""
    return {
        "uploaded_documents": documents_as_files(table(spark, sf_dir, "documents")),
        "uploaded_images": pages_as_files(table(spark, sf_dir, "pages")),
        "uploaded_videos": conversations_as_files(table(spark, sf_dir, "conversations")),
    }


# ---------------------------------------------------------------------------
# Records -> topic-shaped messages
# ---------------------------------------------------------------------------

def to_messages(records: DataFrame, topic: str | Column, key: str | None,
                fields: list[str], id_col: str = "_id",
                time_col: str = "event_time") -> DataFrame:
    """Envelope ``key, value, topic, partition, offset, timestamp``.

    ``value`` is the JSON text of ``fields``; the partition is ``id % 3`` and
    the offset ``id div 3``, so both follow from the row alone (no ranking
    window, no shuffle).
    """
    rid = F.col(id_col).cast("long")
    topic_col = topic if isinstance(topic, Column) else F.lit(topic)
    return records.select(
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        F.to_json(F.struct(*[F.col(f) for f in fields])).alias("value"),
        topic_col.alias("topic"),
        (rid % PARTITIONS).cast("int").alias("partition"),
        F.floor(rid / PARTITIONS).cast("long").alias("offset"),
        F.col(time_col).cast("timestamp").alias("timestamp"),
    )


def transaction_messages(spark: SparkSession, sf_dir: str,
                         topic: str = "transactions") -> DataFrame:
    from streamlens.schemas import TRANSACTION
    return to_messages(load_transactions(spark, sf_dir), topic, "user_id",
                       TRANSACTION.fieldNames())


def frame_messages(spark: SparkSession, sf_dir: str,
                   topic: str = "video_frames") -> DataFrame:
    from streamlens.schemas import VIDEO_FRAME
    return to_messages(load_frames(spark, sf_dir), topic, None, VIDEO_FRAME.fieldNames())


def file_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the three upload topics, keyed by file name."""
    from streamlens.schemas import UPLOADED_FILE
    parts = [to_messages(df, t, "filename", UPLOADED_FILE.fieldNames())
             for t, df in load_file_tables(spark, sf_dir).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Pictures: a frame's payload bytes as the colours of a PNG, so that the image
# source has files to decode (the tables hold no pictures).
# ---------------------------------------------------------------------------
PNG_WIDTH = 64


def _png(data: bytes, width: int = PNG_WIDTH) -> bytes:
    """An 8-bit RGB PNG whose pixels are ``data`` row by row (zero padded)."""
    import struct
    import zlib
    row = 3 * width
    height = max(1, -(-len(data) // row))
    raw = data.ljust(row * height, b"\0")
    rows = b"".join(b"\0" + raw[i * row:(i + 1) * row] for i in range(height))

    def chunk(tag: bytes, body: bytes) -> bytes:
        return (struct.pack(">I", len(body)) + tag + body
                + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF))
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header)
            + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))


@F.pandas_udf(BinaryType())
def picture(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else _png(bytes(b)))


def _docx(text: str) -> bytes:
    """A minimal .docx with one paragraph per line of the text."""
    import io
    import zipfile
    from xml.sax.saxutils import escape
    body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(line, {chr(13): "&#13;"})}</w:t></w:r></w:p>'
                   for line in text.split("\n"))
    xml = ('<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w='
           f'"http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", xml)
    return out.getvalue()


@F.pandas_udf(BinaryType())
def docx_file(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else _docx(t))
