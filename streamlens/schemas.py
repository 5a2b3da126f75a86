"""Record and envelope schemas (Spark StructTypes)."""

from __future__ import annotations

from pyspark.sql import types as T

# Message envelope of a topic; the file twin of a Kafka topic stores the same
# columns as JSON lines.
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("location", T.StringType()),
])

VIDEO_FRAME = T.StructType([
    T.StructField("frame_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("frame_data", T.StringType()),
    T.StructField("frame_width", T.IntegerType()),
    T.StructField("frame_height", T.IntegerType()),
    T.StructField("frame_channels", T.IntegerType()),
    T.StructField("frame_size_bytes", T.LongType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

FILE_METADATA = T.StructType([
    T.StructField("text_content", T.StringType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("fps", T.DoubleType()),
    T.StructField("frame_count", T.LongType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("total_pixels", T.LongType()),
    T.StructField("error", T.StringType()),
])

UPLOADED_FILE = T.StructType([
    T.StructField("file_id", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("upload_timestamp", T.StringType()),
    T.StructField("file_content", T.StringType()),
    T.StructField("metadata", FILE_METADATA),
])

# Which message fields must be present (JSON null counts as present) and how
# each is typed.  ``metadata`` is optional everywhere and defaults to empty.
REQUIRED = {
    "transactions": [f.name for f in TRANSACTION.fields],
    "video_frames": [f.name for f in VIDEO_FRAME.fields if f.name != "metadata"],
    "uploaded_files": [f.name for f in UPLOADED_FILE.fields if f.name != "metadata"],
}
RECORD = {
    "transactions": TRANSACTION,
    "video_frames": VIDEO_FRAME,
    "uploaded_files": UPLOADED_FILE,
}
# Largest magnitude of a number that the money and size arithmetic holds; larger
# or non-finite values are quarantined instead of overflowing in a later step.
LIMITS = {"amount": 1e13, "file_size": 2 ** 50, "frame_size_bytes": 2 ** 50}
# Field carrying the record's own time (ISO-8601 text without zone).
TIME_FIELD = {
    "transactions": "timestamp",
    "video_frames": "timestamp",
    "uploaded_files": "upload_timestamp",
}
