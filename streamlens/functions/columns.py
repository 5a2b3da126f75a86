"""Column expressions for the scalar operations of the three record streams.

Every function returns a ``pyspark.sql.Column`` built from built-in
expressions, so it stays inside whole-stage code generation and works on
static and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "DISCOUNTS", "SOURCE_PROFILES", "FILE_TYPE_PROFILES", "EXTENSIONS",
    "CLIENT_SUFFIXES", "MIME_TYPES", "MIB", "FILE_TYPE_FALLBACK",
    "money", "to_double", "b64encode", "b64decode", "md5_hex", "sha256_prefix",
    "byte_length", "text_length", "word_count", "has_text", "aspect_ratio",
    "orientation", "resolution_class", "size_tier", "size_mb", "video_quality",
    "image_quality", "bitrate_estimate", "video_duration", "extension",
    "file_type_of", "is_allowed", "is_client_allowed", "mime_type", "human_size",
    "text_preview", "iso_text", "parse_time", "discount_multiplier", "case_map",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results.
# ---------------------------------------------------------------------------
# Category discount multipliers; every other category keeps 1.0.
DISCOUNTS = {"electronics": "0.95", "books": "0.90", "clothing": "0.92"}
# Frame source -> (processing note, expected fps); other sources get neither.
SOURCE_PROFILES = {
    "webcam": ("Real-time webcam capture", 30),
    "video_file": ("Pre-recorded video file", 25),
    "sample_generator": ("Generated sample frame", 1),
}
# File type -> (processing note, priority); other types fall to the last entry.
FILE_TYPE_PROFILES = {
    "document": ("Document processing - text extraction completed", "normal"),
    "video": ("Video processing - metadata extraction completed", "high"),
    "image": ("Image processing - metadata extraction completed", "normal"),
}
FILE_TYPE_FALLBACK = ("Unknown file type processing", "low")
# Allowed upload extensions per type (server side).
EXTENSIONS = {
    "document": ["txt", "pdf", "doc", "docx", "rtf"],
    "video": ["mp4", "avi", "mov", "mkv", "wmv", "flv", "webm"],
    "image": ["jpg", "jpeg", "png", "gif", "bmp", "tiff"],
}
# Suffixes the upload page accepts (it has no "rtf").
CLIENT_SUFFIXES = ["pdf", "doc", "docx", "txt", "mp4", "avi", "mov", "mkv", "wmv",
                   "flv", "webm", "jpg", "jpeg", "png", "gif", "bmp", "tiff"]
# MIME type by extension, as the standard mimetypes table gives it.
MIME_TYPES = {
    "txt": "text/plain", "pdf": "application/pdf", "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "rtf": "application/rtf", "mp4": "video/mp4", "avi": "video/x-msvideo",
    "mov": "video/quicktime", "mkv": "video/x-matroska", "wmv": "video/x-ms-wmv",
    "flv": "video/x-flv", "webm": "video/webm", "jpg": "image/jpeg",
    "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif",
    "bmp": "image/bmp", "tiff": "image/tiff",
}
MIB = 1024 * 1024
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def case_map(col, mapping: dict, default=None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END`` from a small dict."""
    col = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def money(col) -> Column:
    """Money as DECIMAL(18,2): exact sums and half-up rounding; NULL when it
    does not fit (the parser quarantines such amounts)."""
    return _c(col).try_cast("decimal(18,2)")


def to_double(col) -> Column:
    return _c(col).cast("double")


def discount_multiplier(category) -> Column:
    m = None
    cat = _c(category)
    for k, v in DISCOUNTS.items():
        cond = cat == F.lit(k)
        lit = F.lit(v).cast("decimal(3,2)")
        m = F.when(cond, lit) if m is None else m.when(cond, lit)
    return m.otherwise(F.lit("1.00").cast("decimal(3,2)"))


def b64encode(binary) -> Column:
    """Base64 text without line breaks (Spark's base64() wraps at 76 chars)."""
    return F.regexp_replace(F.base64(_c(binary)), r"[\r\n]", "")


def b64decode(text) -> Column:
    """Bytes of base64 text; NULL for text that is not base64."""
    return F.try_to_binary(_c(text), F.lit("base64"))


def md5_hex(col) -> Column:
    c = _c(col)
    return F.md5(c if not isinstance(col, str) else F.encode(c, "UTF-8"))


def sha256_prefix(text, n: int = 16) -> Column:
    """First ``n`` hex characters of SHA-256 over the UTF-8 text."""
    return F.substring(F.sha2(F.encode(_c(text), "UTF-8"), 256), 1, n)


def byte_length(col) -> Column:
    return F.octet_length(_c(col)).cast("long")


def text_length(text) -> Column:
    return F.coalesce(F.char_length(_c(text)), F.lit(0)).cast("long")


def word_count(text) -> Column:
    """Number of runs of non-whitespace characters (Unicode-aware)."""
    return F.regexp_count(F.coalesce(_c(text), F.lit("")), F.lit(r"(?U)\S+")).cast("long")


def has_text(text) -> Column:
    return F.coalesce(_c(text).rlike(r"(?U)\S"), F.lit(False))


def aspect_ratio(width, height, scale: int = 2) -> Column:
    """width / height rounded; 0 when height is not positive."""
    w, h = _c(width), _c(height)
    return (F.when(h > 0, F.round(w.cast("double") / h.cast("double"), scale))
            .otherwise(F.lit(0.0)))


def orientation(ratio) -> Column:
    r = _c(ratio)
    return (F.when(r > 1.5, "landscape").when(r < 0.8, "portrait")
            .otherwise("square"))


def resolution_class(width, height) -> Column:
    px = _c(width).cast("long") * _c(height).cast("long")
    return (F.when(px >= 1920 * 1080, "HD").when(px >= 1280 * 720, "HD_Ready")
            .when(px >= 640 * 480, "SD").otherwise("Low"))


def size_mb(size_bytes) -> Column:
    return F.round(_c(size_bytes).cast("double") / MIB, 2)


def size_tier(size_bytes) -> Column:
    """small < 1 MiB <= medium < 10 MiB <= large < 100 MiB <= very_large."""
    b = _c(size_bytes)
    return (F.when(b < MIB, "small").when(b < 10 * MIB, "medium")
            .when(b < 100 * MIB, "large").otherwise("very_large"))


def video_quality(width) -> Column:
    return F.when(F.coalesce(_c(width), F.lit(0)) >= 1280, "HD").otherwise("SD")


def image_quality(width) -> Column:
    w = F.coalesce(_c(width), F.lit(0))
    return F.when(w >= 1920, "High").when(w >= 1280, "Medium").otherwise("Low")


def bitrate_estimate(size_bytes, duration) -> Column:
    d = F.coalesce(_c(duration).cast("double"), F.lit(0.0))
    return (F.when(d > 0, F.round(_c(size_bytes).cast("double") * 8 / d, 2))
            .otherwise(F.lit(0.0)))


def video_duration(frame_count, fps) -> Column:
    f = _c(fps).cast("double")
    return F.when(f > 0, _c(frame_count).cast("double") / f).otherwise(F.lit(0.0))


def extension(filename) -> Column:
    """Lower-cased text after the last dot; NULL when there is no dot."""
    n = _c(filename)
    return F.when(n.contains("."), F.lower(F.substring_index(n, ".", -1)))


def file_type_of(filename) -> Column:
    ext = extension(filename)
    out = F.lit("unknown")
    for t in reversed(list(EXTENSIONS)):
        out = F.when(ext.isin(EXTENSIONS[t]), F.lit(t)).otherwise(out)
    return out


def is_allowed(filename, file_type) -> Column:
    """Server-side rule: has a dot and the suffix is allowed for the type."""
    ext = extension(filename)
    cond = F.lit(False)
    for t, exts in EXTENSIONS.items():
        cond = cond | ((_c(file_type) == F.lit(t)) & ext.isin(exts))
    return F.coalesce(cond, F.lit(False))


def is_client_allowed(filename) -> Column:
    """Upload-page rule: the lower-cased name ends with one of 17 suffixes."""
    return F.coalesce(extension(filename).isin(CLIENT_SUFFIXES), F.lit(False))


def mime_type(filename) -> Column:
    m = F.create_map(*[x for kv in MIME_TYPES.items() for x in map(F.lit, kv)])
    return F.try_element_at(m, extension(filename))


def human_size(size_bytes) -> Column:
    """Bytes / KB / MB / GB with k = 1024 and at most two decimals."""
    b = _c(size_bytes).cast("long")
    units = [("GB", 1024 ** 3), ("MB", 1024 ** 2), ("KB", 1024)]
    scaled = None
    for unit, div in units:
        val = F.round(b.cast("double") / F.lit(float(div)), 2)
        txt = F.concat(F.regexp_replace(val.cast("string"), r"\.0$", ""), F.lit(" " + unit))
        scaled = (F.when(b >= div, txt) if scaled is None else scaled.when(b >= div, txt))
    return (F.when(b == 0, F.lit("0 Bytes"))
            .otherwise(scaled.otherwise(F.concat(b.cast("string"), F.lit(" Bytes")))))


def text_preview(text, n: int = 200) -> Column:
    t = _c(text)
    return F.when(F.char_length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def iso_text(ts) -> Column:
    """ISO-8601 text of a timestamp, microseconds kept."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_time(text) -> Column:
    """Zone-less ISO text -> TIMESTAMP_NTZ; NULL when it is not a time."""
    return _c(text).cast("string").try_cast("timestamp_ntz")
