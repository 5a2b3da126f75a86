"""Per-key totals (A1-A6) and tumbling-window aggregates.

All are hash aggregations with a partial (map-side) step, so a hot key is
pre-aggregated in every task before the shuffle.  They run unchanged on
streaming frames (``update`` mode for totals, ``append`` with a watermark for
windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.columns import money


def user_totals(enriched: DataFrame) -> DataFrame:
    """A1: total spent, transaction count and latest time per user."""
    return enriched.groupBy("user_id").agg(
        F.sum(money("final_amount")).cast("double").alias("total_spent"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.max("event_time").alias("last_updated"))


def source_totals(frames: DataFrame) -> DataFrame:
    """A2: frames, bytes and mean size per source."""
    return frames.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_frames"),
        F.try_sum(F.col("frame_size_bytes").cast("long")).alias("total_size_bytes"),
        F.avg(F.col("frame_width").cast("long")).alias("avg_width"),
        F.avg(F.col("frame_height").cast("long")).alias("avg_height"),
        F.max("event_time").alias("last_updated"))


def file_type_totals(files: DataFrame) -> DataFrame:
    """A3: files, bytes, mean, largest and smallest size per file type."""
    size = F.col("file_size").cast("long")
    return files.groupBy("file_type").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.try_sum(size).alias("total_size_bytes"),
        F.avg(size).alias("avg_size_bytes"),
        F.max(size).alias("largest_file_size"),
        F.min(size).alias("smallest_file_size"),
        F.max("event_time").alias("last_updated"))


def topic_counts(messages: DataFrame) -> DataFrame:
    """A4: messages per topic."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("message_count"))


def frame_sizes(frames: DataFrame) -> DataFrame:
    """Distinct (width, height) pairs."""
    return frames.select("frame_width", "frame_height").distinct()


def _windowed(df: DataFrame, key: Column, key_name: str, length: str,
              time_col: str, measures: list[Column]) -> DataFrame:
    w = F.window(F.col(time_col), length)
    out = df.groupBy(w.alias("_w"), key.alias(key_name)).agg(*measures)
    return out.select(F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"),
                      *[c for c in out.columns if c != "_w"])


def category_window(enriched: DataFrame, length: str = "30 seconds",
                    time_col: str = "event_time") -> DataFrame:
    """Sales and count per category and tumbling window."""
    return _windowed(enriched, F.col("category"), "category", length, time_col, [
        F.sum(money("final_amount")).cast("double").alias("total_amount"),
        F.count(F.lit(1)).alias("transaction_count")])


def resolution_window(frames: DataFrame, length: str = "30 seconds",
                      time_col: str = "event_time") -> DataFrame:
    """Frames, bytes and mean size per resolution class and window."""
    key = F.coalesce(F.col("analysis.resolution_category"), F.lit("unknown"))
    return _windowed(frames, key, "resolution_category", length, time_col, [
        F.count(F.lit(1)).alias("total_frames"),
        F.try_sum(F.col("frame_size_bytes").cast("long")).alias("total_size_bytes"),
        F.avg(F.col("frame_width").cast("long")).alias("avg_width"),
        F.avg(F.col("frame_height").cast("long")).alias("avg_height")])


def size_window(files: DataFrame, length: str = "30 seconds",
                time_col: str = "event_time") -> DataFrame:
    """Files, bytes and mean size per size tier and window."""
    key = F.coalesce(F.col("analysis.size_category"), F.lit("unknown"))
    size = F.col("file_size").cast("long")
    return _windowed(files, key, "size_category", length, time_col, [
        F.count(F.lit(1)).alias("total_files"),
        F.try_sum(size).alias("total_size_bytes"),
        F.avg(size).alias("avg_size_bytes")])


def pairwise_avg_window(df: DataFrame, key: Column, key_name: str,
                        values: dict[str, str], id_col: str,
                        length: str = "30 seconds", time_col: str = "event_time",
                        chunk: str = "second") -> DataFrame:
    """The order-dependent fold ``acc = (acc + x) / 2`` per key and window.

    Folding x1..xn in (time, id) order from ``acc = x1`` gives
    ``sum_j x_j * 2^-j + x_first * 2^-n`` where ``j`` is the position counted
    from the last row (1 = last).  ``j`` comes from the chunked running count
    (no single task holds a whole group) and the sum is a plain aggregation.
    The result equals the sequential fold exactly while the terms fit in a
    double's mantissa and otherwise differs only by rounding.
    """
    from streamlens.operators.running import running_stats
    w = F.window(F.col(time_col), length)
    staged = df.select(w.start.alias("window_start"), w.end.alias("window_end"),
                       key.alias(key_name), F.col(time_col).alias("_t"),
                       F.col(id_col).alias("_id"),
                       *[F.col(c).cast("double").alias(f"_x_{n}") for n, c in values.items()])
    ranked = running_stats(staged, ["window_start", key_name], ["_t", "_id"],
                           {"_j": ("count", None)}, time_col="_t", chunk=chunk,
                           descending=True)
    first = F.struct(F.col("_t"), F.col("_id"))
    aggs = []
    for n in values:
        x = F.col(f"_x_{n}")
        aggs += [F.sum(x * F.pow(F.lit(2.0), -F.col("_j"))).alias(f"_s_{n}"),
                 F.min_by(x, first).alias(f"_f_{n}")]
    out = ranked.groupBy("window_start", "window_end", key_name).agg(
        F.count(F.lit(1)).alias("_n"), *aggs)
    return out.select("window_start", "window_end", key_name,
                      *[(F.col(f"_s_{n}") + F.col(f"_f_{n}") * F.pow(F.lit(2.0), -F.col("_n")))
                        .alias(n) for n in values])


def pairwise_avg_closed(df: DataFrame, key: Column, key_name: str, values: dict[str, str], id_col: str,
                        length: str = "30 seconds", time_col: str = "event_time",
                        chunk: str = "1 second") -> DataFrame:
    """W4 on a stream in ``append`` mode (a batch frame works too): the fold per
    key and window, in (time, id) order whatever order the rows arrive in.

    Two chained window aggregations.  The first keeps the rows of a key and time
    chunk until the watermark has passed the chunk, then folds them into a
    segment: their number n and s = the fold from 0.  The second keeps the
    segments of a key and window until the window closes, and puts them together
    in time order: after a value ``acc``, a segment gives ``acc * 2^-n + s``.
    So the state of a window is its open chunks' rows and one small row per
    closed chunk.  A key's rows of one chunk meet in one task; ``chunk`` must
    divide ``length``, and a finer one suits a higher rate.
    """
    names = list(values)
    row = F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("id"),
                   *[F.col(c).cast("double").alias(n) for n, c in values.items()])
    rows = df.groupBy(F.window(F.col(time_col), chunk).alias("_chunk"), key.alias(key_name)).agg(
        F.sort_array(F.collect_list(row)).alias("_rows"))

    def folded(n: str) -> Column:
        return F.aggregate("_rows", F.lit(0.0), lambda acc, r: (acc + r[n]) / 2)

    def joined(n: str) -> Column:
        return F.aggregate("_segments", F.col("_segments")[0][f"first_{n}"],
                           lambda acc, g: acc * F.pow(F.lit(2.0), -g["n"]) + g[f"s_{n}"])

    segments = rows.select(
        "_chunk", key_name, F.struct(
            F.col("_chunk.start").alias("at"), F.size("_rows").alias("n"),
            *[F.col("_rows")[0][n].alias(f"first_{n}") for n in names],
            *[folded(n).alias(f"s_{n}") for n in names]).alias("_segment"))
    closed = segments.groupBy(F.window(F.col("_chunk"), length).alias("_w"), F.col(key_name)).agg(
        F.sort_array(F.collect_list("_segment")).alias("_segments"))
    return closed.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), key_name,
        *[joined(n).alias(n) for n in names])
