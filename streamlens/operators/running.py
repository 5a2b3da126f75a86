"""Per-record running statistics (R1-R3) in their batch (OVER) form.

A running value per key is a prefix scan in (time, id) order.  A plain
``sum(...) OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key to
one task, which does not survive a key that holds a third of all rows.  The
scan is therefore split in two levels:

1. rows are cut into time chunks (``date_trunc(chunk, time)``); the scan inside
   a chunk is a window partitioned by ``(key, chunk)``, so a hot key spreads
   over as many tasks as it has chunks;
2. per-chunk totals (one row per key and chunk) are scanned per key to get what
   every earlier chunk contributes, and joined back on ``(key, chunk)``.

Both levels read the same exchange of the rows on ``(key, chunk)``, so the
input is scanned and parsed once and its rows move once.

Sums, counts, minima and maxima compose this way; means are sum / count.
Rows without a time come last, in the order of a hash of the order columns;
that hash also spreads them over chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CH = "_chunk"
_FAR, _EARLY = "9999-12-31 00:00:00", "0001-01-01 00:00:00"
_NO_TIME_CHUNKS = 256
CHUNKS = ("microsecond", "millisecond", "second", "minute", "hour", "day", "week", "month", "quarter", "year")


def combine(kind: str, prev: Column, cur: Column) -> Column:
    """The statistic of two parts; a part that is NULL does not count."""
    if kind in ("sum", "count"):
        return F.coalesce(F.try_add(prev, cur), F.when(prev.isNull(), cur).when(cur.isNull(), prev))
    if kind == "min":
        return F.least(prev, cur)
    if kind == "max":
        return F.greatest(prev, cur)
    raise ValueError(kind)


def _agg(kind: str, col: Column | None) -> Column:
    if kind == "count":
        return F.count(F.lit(1))
    return {"sum": F.try_sum, "min": F.min, "max": F.max}[kind](col)


def running_stats(df: DataFrame, key: str | list[str], order: list[str],
                  aggs: dict[str, tuple[str, Column | str | None]],
                  time_col: str = "event_time", chunk: str = "hour",
                  descending: bool = False) -> DataFrame:
    """Add one running column per ``aggs`` entry ``name -> (kind, column)``.

    ``kind`` is ``sum``, ``count``, ``min`` or ``max``; values are over all
    rows of the same key up to and including the current row in ``order``
    (reversed when ``descending``).  ``chunk`` is a ``date_trunc`` unit.

    Narrow ``df`` to the columns the result needs first: all its columns go
    through the one exchange that both levels share.
    """
    if chunk not in CHUNKS:
        raise ValueError(f"chunk must be one of {', '.join(CHUNKS)}, not {chunk!r}")
    keys = [key] if isinstance(key, str) else list(key)
    specs = {n: (k, (F.col(c) if isinstance(c, str) else c)) for n, (k, c) in aggs.items()}
    last = F.lit(_EARLY if descending else _FAR).cast("timestamp_ntz")
    spread = F.make_dt_interval(secs=F.pmod(F.xxhash64(*order), F.lit(_NO_TIME_CHUNKS)))
    chunk_col = F.coalesce(F.date_trunc(chunk, F.col(time_col)).cast("timestamp_ntz"), last + spread)
    # Null-safe keys as plain columns: value (NULL -> typed default) + null flag.
    kcols = []
    d = df.withColumn(_CH, chunk_col)
    for i, k in enumerate(keys):
        dtype = df.schema[k].dataType.simpleString()
        d = (d.withColumn(f"_kv{i}", F.coalesce(F.col(k), F.lit(_DEFAULTS.get(dtype, "")).cast(dtype)))
              .withColumn(f"_kn{i}", F.col(k).isNull()))
        kcols += [f"_kv{i}", f"_kn{i}"]
    columns = d.columns
    d = d.repartition(*kcols, _CH)

    def _o(c: str) -> Column:
        return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()

    inner = (Window.partitionBy(*kcols, _CH).orderBy(*[_o(c) for c in order])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cur = d
    for n, (k, c) in specs.items():
        cur = cur.withColumn(f"_cur_{n}", _agg(k, c).over(inner))

    # The totals read every column (through a hash that is never NULL), so that
    # column pruning leaves both branches the same exchange and Spark reuses it.
    totals = d.groupBy(*kcols, _CH).agg(
        F.bit_xor(F.xxhash64(*columns)).alias("_all"),
        *[_agg(k, c).alias(f"_tot_{n}") for n, (k, c) in specs.items()]).where("_all is not null")
    ch_order = F.col(_CH).desc() if descending else F.col(_CH).asc()
    before = (Window.partitionBy(*kcols).orderBy(ch_order)
              .rowsBetween(Window.unboundedPreceding, -1))
    prev = totals.select(*kcols, _CH,
                         *[{"sum": F.try_sum, "count": F.sum, "min": F.min, "max": F.max}[k](
                             F.col(f"_tot_{n}")).over(before).alias(f"_prev_{n}")
                           for n, (k, _) in specs.items()])
    out = cur.join(prev, kcols + [_CH], "left")
    for n, (k, _) in specs.items():
        out = out.withColumn(n, combine(k, F.col(f"_prev_{n}"), F.col(f"_cur_{n}")))
    drop = ([_CH] + kcols + [f"_cur_{n}" for n in specs]
            + [f"_prev_{n}" for n in specs])
    return out.drop(*drop)


# Stand-ins for NULL keys (the separate null flag keeps them apart from real values).
_DEFAULTS = {"string": "", "bigint": "0", "int": "0", "double": "0",
             "timestamp_ntz": "1970-01-01 00:00:00", "timestamp": "1970-01-01 00:00:00",
             "boolean": "false", "date": "1970-01-01"}

# Running aggregates of the record kinds: output name -> (kind, input column).
# ``order`` fixes the row order, ``carry`` the record columns of the output.
SPECS = {
    "transactions": {
        "key": "user_id", "order": ["event_time", "transaction_id"],
        "aggs": {"transaction_count": ("count", None), "total_spent": ("sum", "spent"),
                 "last_updated": ("max", "event_time")},
        "carry": ["transaction_id", "user_id", "event_time", "final_amount"],
    },
    "video_frames": {
        "key": "source", "order": ["event_time", "frame_id"],
        "aggs": {"total_frames": ("count", None), "total_size_bytes": ("sum", "frame_size_bytes"),
                 "sum_width": ("sum", "frame_width"), "sum_height": ("sum", "frame_height"),
                 "last_updated": ("max", "event_time")},
        "carry": ["frame_id", "source", "event_time"],
    },
    "uploaded_files": {
        "key": "file_type", "order": ["event_time", "file_id"],
        "aggs": {"total_files": ("count", None), "total_size_bytes": ("sum", "file_size"),
                 "largest_file_size": ("max", "file_size"), "smallest_file_size": ("min", "file_size"),
                 "last_updated": ("max", "event_time")},
        "carry": ["file_id", "file_type", "event_time"],
    },
}


def narrowed(records: DataFrame, kind: str) -> DataFrame:
    """The columns that the running statistics of ``kind`` need; measures as
    exact numbers (money as a decimal, sizes as longs)."""
    from streamlens.functions.columns import money
    spec = SPECS[kind]
    inputs = dict.fromkeys(c for _, c in spec["aggs"].values() if c and c != "event_time")
    typed = [money("final_amount").alias(c) if c == "spent" else F.col(c).cast("long").alias(c) for c in inputs]
    return records.select(*spec["carry"], *typed)


def finished(stats: DataFrame, kind: str) -> DataFrame:
    """Derived columns of the running output (money as double, means)."""
    if kind == "transactions":
        return stats.withColumn("total_spent", F.col("total_spent").cast("double")).drop("spent")
    if kind == "video_frames":
        return (stats.withColumn("avg_width", F.col("sum_width") / F.col("total_frames"))
                .withColumn("avg_height", F.col("sum_height") / F.col("total_frames"))
                .drop("sum_width", "sum_height", "frame_size_bytes", "frame_width", "frame_height"))
    return stats.withColumn("avg_size_bytes", F.col("total_size_bytes") / F.col("total_files")).drop("file_size")


def in_order(records: DataFrame, kind: str, chunk: str = "hour") -> DataFrame:
    """The running statistics of narrowed records, before ``finished``."""
    spec = SPECS[kind]
    return running_stats(records, spec["key"], spec["order"], spec["aggs"], chunk=chunk)


def running_records(records: DataFrame, kind: str, chunk: str = "hour") -> DataFrame:
    """Per record, its user's, source's or file type's statistics so far."""
    return finished(in_order(narrowed(records, kind), kind, chunk), kind)
