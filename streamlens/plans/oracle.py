"""DuckDB SQL twins of the registered queries (the correctness oracle).

The SQL computes each result straight from the driver's tables with the
adapter rules of FIXTURES.md; the Spark side goes through JSON messages, the
parser and the operators.  Equal results therefore check the whole path.
"""

from __future__ import annotations

from streamlens.functions.columns import (CLIENT_SUFFIXES, DISCOUNTS, EXTENSIONS,
                                          FILE_TYPE_FALLBACK, FILE_TYPE_PROFILES,
                                          MIME_TYPES, SOURCE_PROFILES)
from streamlens.sources import adapters as A


def _q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _pick(expr: str, values: list) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v) if isinstance(v, str) else v}"
                     for i, v in enumerate(values[:-1]))
    last = values[-1]
    return f"CASE {expr} {whens} ELSE {_q(last) if isinstance(last, str) else last} END"


def _map(expr: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {v if not isinstance(v, str) else _q(v)}"
                     for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


K = "CAST(json_extract(props, '$.k') AS INTEGER)"
ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S.%f')"
B64 = "to_base64(encode({x}))"
EPOCH = f"TIMESTAMP '{A.EPOCH}'"

TXN = f"""txn AS (
  SELECT 'txn_' || event_id AS transaction_id,
         'user_' || user_id AS user_id,
         {_pick(f'{K} % 8', A.PRODUCTS)} AS product,
         {_map('event_type', A.EVENT_CATEGORY, "'accessories'")} AS category,
         CAST(CASE WHEN event_id % {A.LARGE_EVERY} = 0 THEN value * {A.LARGE_FACTOR} ELSE value END AS DOUBLE) AS amount,
         CAST(event_id % 5 + 1 AS INTEGER) AS quantity,
         {_pick('event_id % 4', A.PAYMENTS)} AS payment_method,
         {ISO.format(t='ts')} AS "timestamp",
         'city_' || ({K} % 50 + 1) AS location,
         event_id AS _id,
         CAST(ts AS TIMESTAMP) AS event_time
  FROM events)"""

_MULT = " ".join(
    ["CASE category"] + [f"WHEN {_q(k)} THEN CAST({v} AS DECIMAL(3,2))" for k, v in DISCOUNTS.items()]
    + ["ELSE CAST(1.00 AS DECIMAL(3,2)) END"])

PROC_TXN = f"""proc_txn AS (
  SELECT *, amount AS original_amount,
         CAST({_MULT} AS DOUBLE) AS discount_applied,
         CAST(round(CAST(amount AS DECIMAL(12,2)) * {_MULT}, 2) AS DOUBLE) AS final_amount
  FROM txn WHERE amount > 100.0 AND NOT isnan(amount))"""

_W = [w for w, _ in A.FRAME_SIZES]
_H = [h for _, h in A.FRAME_SIZES]
FRAMES = f"""frames AS (
  SELECT 'frame_' || doc_id AS frame_id,
         {ISO.format(t=EPOCH + ' + to_seconds(doc_id)')} AS "timestamp",
         {_pick('doc_id % 4', A.FRAME_SOURCES)} AS source,
         {B64.format(x='text')} AS frame_data,
         CAST({_pick('doc_id % 7', _W)} AS INTEGER) AS frame_width,
         CAST({_pick('doc_id % 7', _H)} AS INTEGER) AS frame_height,
         3 AS frame_channels,
         CAST(length({B64.format(x='text')}) AS BIGINT) AS frame_size_bytes,
         CAST(octet_length(encode(text)) AS BIGINT) AS _decoded_len,
         doc_id AS _id,
         {EPOCH} + to_seconds(doc_id) AS event_time
  FROM documents)"""

_SRC_NOTES = {k: v[0] for k, v in SOURCE_PROFILES.items()}
_SRC_FPS = {k: v[1] for k, v in SOURCE_PROFILES.items()}
_RATIO = "(CAST(frame_width AS DOUBLE) / frame_height)"
_PX = "(CAST(frame_width AS BIGINT) * frame_height)"
FRAME_ANALYSIS_COLS = f"""round({_RATIO}, 2) AS aspect_ratio,
         {_PX} AS total_pixels,
         round(CAST(_decoded_len AS DOUBLE) / ({_PX} * 3), 3) AS compression_ratio,
         CASE WHEN {_RATIO} > 1.5 THEN 'landscape' WHEN {_RATIO} < 0.8 THEN 'portrait'
              ELSE 'square' END AS orientation,
         CASE WHEN {_PX} >= 2073600 THEN 'HD' WHEN {_PX} >= 921600 THEN 'HD_Ready'
              WHEN {_PX} >= 307200 THEN 'SD' ELSE 'Low' END AS resolution_category"""

PROC_FRAMES = f"""proc_frames AS (
  SELECT *, {FRAME_ANALYSIS_COLS},
         {_map('source', _SRC_NOTES)} AS processing_notes,
         CAST({_map('source', _SRC_FPS)} AS INTEGER) AS expected_fps
  FROM frames WHERE frame_width >= 640 AND frame_height >= 480)"""

_FW = [w for w, _ in A.FILE_SIZES]
_FH = [h for _, h in A.FILE_SIZES]


def _mime(name: str) -> str:
    ext = f"lower(regexp_extract({name}, '\\.([^.]*)$', 1))"
    return _map(ext, MIME_TYPES)


def _upload(n: str) -> str:
    return f"{EPOCH} + to_seconds(({n}) * {A.UPLOAD_STEP_SECONDS})"


FILES = f"""files AS (
  SELECT 'document_' || doc_id AS file_id, 'doc_' || doc_id || '.txt' AS filename,
         'document' AS file_type, CAST(octet_length(encode(text)) AS BIGINT) * {A.FILE_SIZE_FACTOR} AS file_size,
         md5(text) AS file_hash, {ISO.format(t=_upload('doc_id'))} AS upload_timestamp,
         {B64.format(x='text')} AS file_content, 'uploaded_documents' AS topic,
         text AS text_content, {_mime("'x.txt'")} AS mime_type,
         CAST(NULL AS DOUBLE) AS fps, CAST(NULL AS BIGINT) AS frame_count,
         CAST(NULL AS DOUBLE) AS duration, CAST(NULL AS INTEGER) AS width,
         CAST(NULL AS INTEGER) AS height, CAST(NULL AS INTEGER) AS channels,
         CAST(NULL AS BIGINT) AS total_pixels, doc_id AS _id, {_upload('doc_id')} AS event_time
  FROM documents
  UNION ALL
  SELECT 'image_' || page_id, 'page_' || page_id || '.png', 'image',
         CAST(octet_length(encode(html)) AS BIGINT) * {A.FILE_SIZE_FACTOR}, md5(html),
         {ISO.format(t=_upload('page_id'))}, {B64.format(x='html')}, 'uploaded_images',
         NULL, {_mime("'x.png'")}, NULL, NULL, NULL,
         CAST({_pick('page_id % 3', _FW)} AS INTEGER), CAST({_pick('page_id % 3', _FH)} AS INTEGER),
         CASE WHEN page_id % 5 = 0 THEN 1 ELSE 3 END,
         CAST({_pick('page_id % 3', _FW)} AS BIGINT) * {_pick('page_id % 3', _FH)},
         page_id, {_upload('page_id')}
  FROM pages
  UNION ALL
  SELECT 'video_' || conv_id || '_' || turn, 'conv_' || conv_id || '_' || turn || '.mp4', 'video',
         CAST(octet_length(encode(text)) AS BIGINT) * {A.FILE_SIZE_FACTOR}, md5(text),
         {ISO.format(t=_upload('conv_id * 100 + turn'))}, {B64.format(x='text')}, 'uploaded_videos',
         NULL, {_mime("'x.mp4'")}, {_pick('turn % 3', A.VIDEO_FPS)}, (turn + 1) * 300,
         CASE WHEN {_pick('turn % 3', A.VIDEO_FPS)} > 0
              THEN CAST((turn + 1) * 300 AS DOUBLE) / {_pick('turn % 3', A.VIDEO_FPS)} ELSE 0.0 END,
         CAST({_pick('conv_id % 3', _FW)} AS INTEGER), CAST({_pick('conv_id % 3', _FH)} AS INTEGER),
         NULL, NULL, conv_id * 100 + turn, {_upload('conv_id * 100 + turn')}
  FROM conversations)"""

# Unicode-aware whitespace (Java's (?U)\s): RE2's \s is ASCII only.
WS = "[\\t\\n\\x0B\\f\\r \\x{85}\\p{Z}]"
_TYPE_NOTES = {k: v[0] for k, v in FILE_TYPE_PROFILES.items()}
_TYPE_PRIO = {k: v[1] for k, v in FILE_TYPE_PROFILES.items()}
_MIB = 1024 * 1024
_W0 = "coalesce(width, 0)"
_H0 = "coalesce(height, 0)"
_AR = f"CASE WHEN {_H0} > 0 THEN round(CAST({_W0} AS DOUBLE) / {_H0}, 2) ELSE 0.0 END"

FILE_ANALYSIS_COLS = f"""round(CAST(file_size AS DOUBLE) / {_MIB}, 2) AS file_size_mb,
         CASE WHEN file_size < {_MIB} THEN 'small' WHEN file_size < {10 * _MIB} THEN 'medium'
              WHEN file_size < {100 * _MIB} THEN 'large' ELSE 'very_large' END AS size_category,
         substr(sha256(file_content), 1, 16) AS content_hash,
         CASE WHEN file_type = 'document' THEN CAST(coalesce(length(text_content), 0) AS BIGINT) END AS text_length,
         CASE WHEN file_type = 'document' THEN CAST(len(list_filter(
              regexp_split_to_array(coalesce(text_content, ''), '{WS}+'), lambda w: length(w) > 0)) AS BIGINT) END AS word_count,
         CASE WHEN file_type = 'document' THEN coalesce(regexp_matches(text_content, '[^\\t\\n\\x0B\\f\\r \\x{{85}}\\p{{Z}}]'), false) END AS has_text,
         CASE WHEN file_type = 'video' THEN CASE WHEN {_W0} >= 1280 THEN 'HD' ELSE 'SD' END END AS video_quality,
         CASE WHEN file_type IN ('video', 'image') THEN {_AR} END AS aspect_ratio,
         CASE WHEN file_type = 'video' THEN CAST(coalesce(frame_count, 0) AS BIGINT) END AS total_frames,
         CASE WHEN file_type = 'video' THEN CASE WHEN coalesce(duration, 0) > 0
              THEN round(CAST(file_size AS DOUBLE) * 8 / duration, 2) ELSE 0.0 END END AS bitrate_estimate,
         CASE WHEN file_type = 'image' THEN CASE WHEN {_W0} >= 1920 THEN 'High'
              WHEN {_W0} >= 1280 THEN 'Medium' ELSE 'Low' END END AS image_quality,
         CASE WHEN file_type = 'image' THEN CAST({_W0} AS BIGINT) * {_H0} END AS a_total_pixels,
         CASE WHEN file_type = 'image' THEN CAST(coalesce(channels, 0) AS BIGINT) * 8 END AS color_depth"""

PROC_FILES = f"""proc_files AS (
  SELECT *, {FILE_ANALYSIS_COLS},
         {_map('file_type', _TYPE_NOTES, _q(FILE_TYPE_FALLBACK[0]))} AS processing_notes,
         {_map('file_type', _TYPE_PRIO, _q(FILE_TYPE_FALLBACK[1]))} AS processing_priority
  FROM files WHERE file_size > {_MIB})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def window_cols(t: str = "event_time", length: str = "30 seconds") -> str:
    return (f"time_bucket(INTERVAL '{length}', {t}) AS window_start, "
            f"time_bucket(INTERVAL '{length}', {t}) + INTERVAL '{length}' AS window_end")


def ext_sql(name: str) -> str:
    return f"CASE WHEN contains({name}, '.') THEN lower(regexp_extract({name}, '\\.([^.]*)$', 1)) END"


def file_type_sql(name: str) -> str:
    e = ext_sql(name)
    parts = " ".join(f"WHEN {e} IN ({', '.join(map(_q, exts))}) THEN {_q(t)}"
                     for t, exts in EXTENSIONS.items())
    return f"CASE {parts} ELSE 'unknown' END"


def allowed_sql(name: str, type_expr: str) -> str:
    e = ext_sql(name)
    parts = " OR ".join(f"({type_expr} = {_q(t)} AND {e} IN ({', '.join(map(_q, exts))}))"
                        for t, exts in EXTENSIONS.items())
    return f"coalesce({parts}, false)"


def client_allowed_sql(name: str) -> str:
    return f"coalesce({ext_sql(name)} IN ({', '.join(map(_q, CLIENT_SUFFIXES))}), false)"


def human_size_sql(b: str) -> str:
    def unit(div: int, u: str) -> str:
        return (f"regexp_replace(CAST(round(CAST({b} AS DOUBLE) / {float(div)}, 2) AS VARCHAR), "
                f"'\\.0$', '') || ' {u}'")
    return (f"CASE WHEN {b} = 0 THEN '0 Bytes' WHEN {b} >= {1024 ** 3} THEN {unit(1024 ** 3, 'GB')} "
            f"WHEN {b} >= {1024 ** 2} THEN {unit(1024 ** 2, 'MB')} WHEN {b} >= 1024 THEN {unit(1024, 'KB')} "
            f"ELSE CAST({b} AS VARCHAR) || ' Bytes' END")
