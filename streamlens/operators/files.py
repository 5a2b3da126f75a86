"""Uploaded-file operators: U1, F3, F5-F7, E4-E8, X6-X21."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.columns import (FILE_TYPE_FALLBACK, FILE_TYPE_PROFILES,
                                          MIB, aspect_ratio, bitrate_estimate,
                                          case_map, file_type_of, has_text,
                                          image_quality, sha256_prefix,
                                          size_mb, size_tier, text_length,
                                          video_quality, word_count)


def union_all(*frames: DataFrame) -> DataFrame:
    """Union of several file streams by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def large_files(df: DataFrame, min_bytes: int = MIB) -> DataFrame:
    return df.filter(F.col("file_size") > F.lit(min_bytes))


def analyze(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Add the ``analysis`` struct: common members for every file, and the
    document / video / image members for the matching type (NULL otherwise)."""
    m = "metadata"
    ft = F.col("file_type")
    is_doc, is_vid, is_img = ft == "document", ft == "video", ft == "image"
    text = F.col(f"{m}.text_content")
    width = F.coalesce(F.col(f"{m}.width"), F.lit(0))
    height = F.coalesce(F.col(f"{m}.height"), F.lit(0))
    analysis = F.struct(
        size_mb("file_size").alias("file_size_mb"),
        size_tier("file_size").alias("size_category"),
        (now if now is not None else F.current_timestamp()).alias("processing_timestamp"),
        sha256_prefix("file_content").alias("content_hash"),
        F.when(is_doc, text_length(text)).alias("text_length"),
        F.when(is_doc, word_count(text)).alias("word_count"),
        F.when(is_doc, has_text(text)).alias("has_text"),
        F.when(is_vid, video_quality(width)).alias("video_quality"),
        F.when(is_vid | is_img, aspect_ratio(width, height)).alias("aspect_ratio"),
        F.when(is_vid, F.coalesce(F.col(f"{m}.frame_count"), F.lit(0)).cast("long")).alias("total_frames"),
        F.when(is_vid, bitrate_estimate("file_size", F.col(f"{m}.duration"))).alias("bitrate_estimate"),
        F.when(is_img, image_quality(width)).alias("image_quality"),
        F.when(is_img, width.cast("long") * height.cast("long")).alias("total_pixels"),
        F.when(is_img, F.coalesce(F.col(f"{m}.channels"), F.lit(0)).cast("long") * 8).alias("color_depth"),
    )
    return df.withColumn("analysis", analysis)


def type_enrich(df: DataFrame, now: Column | None = None) -> DataFrame:
    notes = {k: v[0] for k, v in FILE_TYPE_PROFILES.items()}
    prio = {k: v[1] for k, v in FILE_TYPE_PROFILES.items()}
    return (df.withColumn("processing_notes", case_map("file_type", notes, FILE_TYPE_FALLBACK[0]))
              .withColumn("processing_priority", case_map("file_type", prio, FILE_TYPE_FALLBACK[1]))
              .withColumn("enriched_at", now if now is not None else F.current_timestamp()))


def reject_unknown(df: DataFrame, name: str = "filename") -> DataFrame:
    return df.filter(file_type_of(name) != "unknown")
