"""Video frame operators: F2, E2, E3, S16."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.columns import (SOURCE_PROFILES, b64decode, case_map,
                                          orientation, resolution_class)


def high_resolution(df: DataFrame, min_width: int = 640, min_height: int = 480) -> DataFrame:
    return df.filter((F.col("frame_width") >= min_width) & (F.col("frame_height") >= min_height))


def analyze(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Add the ``analysis`` struct; NULL when the payload is not base64 or the
    height is zero (the upstream analysis step then fails)."""
    w = F.col("frame_width").cast("long")
    h = F.col("frame_height").cast("long")
    decoded_len = F.octet_length(b64decode("frame_data"))
    ratio = w.cast("double") / h.cast("double")
    analysis = F.struct(
        F.round(ratio, 2).alias("aspect_ratio"),
        (w * h).alias("total_pixels"),
        F.round(decoded_len.cast("double") / ((w * h).cast("double") * 3), 3).alias("compression_ratio"),
        (now if now is not None else F.current_timestamp()).alias("processing_timestamp"),
        orientation(ratio).alias("orientation"),
        resolution_class(w, h).alias("resolution_category"),
    )
    ok = decoded_len.isNotNull() & (h != 0)
    return df.withColumn("analysis", F.when(ok, analysis))


def source_enrich(df: DataFrame, now: Column | None = None) -> DataFrame:
    notes = {k: v[0] for k, v in SOURCE_PROFILES.items()}
    fps = {k: v[1] for k, v in SOURCE_PROFILES.items()}
    return (df.withColumn("processing_notes", case_map("source", notes))
              .withColumn("expected_fps", case_map("source", fps).cast("int"))
              .withColumn("enriched_at", now if now is not None else F.current_timestamp()))


def stride_sample(df: DataFrame, every: int, key: str = "source",
                  order: tuple[str, ...] = ("event_time", "frame_id"),
                  chunk: str = "hour") -> DataFrame:
    """Keep every ``every``-th frame per ``key`` in (time, id) order, counting
    from the first (position 0, n, 2n, ...).  The position is a scalable
    running count (see :mod:`streamlens.operators.running`)."""
    from streamlens.operators.running import running_stats
    ranked = running_stats(df, key, list(order), {"_pos": ("count", None)},
                           time_col=order[0], chunk=chunk)
    n = max(1, int(every))
    return ranked.filter((F.col("_pos") - 1) % n == 0).withColumn(
        "position", (F.col("_pos") - 1).cast("long")).drop("_pos")


def stride_for(fps: float, interval: float) -> int:
    """Frames between samples for a capture rate and a sampling interval."""
    return max(1, int(fps * interval))
