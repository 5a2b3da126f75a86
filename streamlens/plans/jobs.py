"""The three jobs as compositions of operators.

Each ``processed_*`` function is the main path of one job: parse the message
value, keep accepted records, filter, enrich.  It takes a static or streaming
frame of messages (``value`` column plus optional envelope) and returns the
enriched records.  The branches hang off that result: processed records to a
sink, running / total statistics per entity, tumbling windows per class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from streamlens.functions.columns import MIB
from streamlens.operators import files as fo
from streamlens.operators import frames as vo
from streamlens.operators import transactions as to
from streamlens.operators.parse import (accepted, parse_files, parse_frames,
                                        parse_transactions)


def enriched_transactions(records: DataFrame, threshold: float = 100.0,
                          now: Column | str | None = None) -> DataFrame:
    """F1 -> E1 on accepted records."""
    return to.enrich(to.high_value(records, threshold), as_of=now)


def analyzed_frames(records: DataFrame, min_width: int = 640, min_height: int = 480,
                    now: Column | None = None) -> DataFrame:
    """F2 -> E2 on accepted records."""
    return vo.analyze(vo.high_resolution(records, min_width, min_height), now)


def analyzed_files(records: DataFrame, min_bytes: int = MIB, now: Column | None = None) -> DataFrame:
    """F3 -> E4-E7 on accepted records."""
    return fo.analyze(fo.large_files(records, min_bytes), now)


# The main path of each kind after the parse.
ENRICHED = {
    "transactions": enriched_transactions,
    "video_frames": lambda records: vo.source_enrich(analyzed_frames(records)),
    "uploaded_files": lambda records: fo.type_enrich(analyzed_files(records)),
}


def processed_transactions(messages: DataFrame, threshold: float = 100.0,
                           now: Column | str | None = None, **parse) -> DataFrame:
    """P1 -> P4 -> F1 -> E1.  ``parse``: options of ``parse_messages``."""
    return enriched_transactions(accepted(parse_transactions(messages, **parse)), threshold, now)


def processed_frames(messages: DataFrame, min_width: int = 640, min_height: int = 480,
                     now: Column | None = None, **parse) -> DataFrame:
    """P2 -> P4 -> F2 -> E2 -> E3."""
    records = accepted(parse_frames(messages, **parse))
    return vo.source_enrich(analyzed_frames(records, min_width, min_height, now), now)


def processed_files(messages: DataFrame, min_bytes: int = MIB,
                    now: Column | None = None, **parse) -> DataFrame:
    """(U1) -> P3 -> P4 -> F3 -> E4-E7 -> E8."""
    return fo.type_enrich(analyzed_files(accepted(parse_files(messages, **parse)), min_bytes, now), now)


# Columns written to the processed-record topics (wall-clock columns last).
PROCESSED_COLUMNS = {
    "transactions": to.RECORD_COLS + ["original_amount", "discount_applied",
                                      "final_amount", "processing_timestamp"],
    "video_frames": ["frame_id", "timestamp", "source", "frame_data", "frame_width",
                     "frame_height", "frame_channels", "frame_size_bytes", "metadata",
                     "analysis", "processing_notes", "expected_fps", "enriched_at"],
    "uploaded_files": ["file_id", "filename", "file_type", "file_size", "file_hash",
                       "upload_timestamp", "file_content", "metadata", "analysis",
                       "processing_notes", "processing_priority", "enriched_at"],
}
