import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlens.operators import aggregates as agg
from streamlens.operators.running import CHUNKS, running_stats


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, id long, t string, x long").withColumn(
        "event_time", F.col("t").cast("timestamp_ntz"))


def brute(rows):
    pdf = pd.DataFrame(rows, columns=["k", "id", "t", "x"]).sort_values(["k", "t", "id"])
    g = pdf.groupby("k")
    pdf["c"] = g.cumcount() + 1
    pdf["s"] = g["x"].cumsum()
    pdf["mx"] = g["x"].cummax()
    pdf["mn"] = g["x"].cummin()
    return {r.id: (r.c, r.s, r.mx, r.mn) for r in pdf.itertuples()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "a", "b"]), st.integers(0, 3 * 24 * 3600),
                          st.integers(-50, 50)), min_size=1, max_size=60))
def test_running_matches_brute_force(spark, data):
    rows = [(k, i, str(pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)), x)
            for i, (k, s, x) in enumerate(data)]
    out = running_stats(frame(spark, rows), "k", ["event_time", "id"],
                        {"c": ("count", None), "s": ("sum", "x"), "mx": ("max", "x"),
                         "mn": ("min", "x")}, chunk="hour")
    got = {r.id: (r.c, r.s, r.mx, r.mn) for r in out.collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("null_times", [False, True])
def test_hot_key_has_many_chunks(spark, null_times):
    """The exchange of one hot key fills many partitions, with and without times."""
    df = spark.range(4000).select(
        F.lit("hot").alias("k"), F.col("id"), F.col("id").alias("x"),
        (F.lit(None) if null_times else F.timestamp_seconds(F.col("id") * 60)).cast("timestamp_ntz").alias("event_time"))
    out = running_stats(df, "k", ["event_time", "id"], {"s": ("sum", "x"), "c": ("count", None)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts >= 4
    assert out.agg(F.max("c"), F.max("s")).first() == (4000, sum(range(4000)))
    assert out.select("c").distinct().count() == 4000


def test_unknown_chunk_is_refused(spark):
    for bad in ("1 hour", "hours", ""):
        with pytest.raises(ValueError):
            running_stats(frame(spark, [("a", 1, None, 1)]), "k", ["event_time", "id"], {"c": ("count", None)}, chunk=bad)
    assert "hour" in CHUNKS


def test_null_measures_do_not_count(spark):
    rows = [("a", 1, "2024-01-01 00:00:00", 1), ("a", 2, "2024-01-01 01:00:00", None), ("a", 3, "2024-01-01 01:00:01", 5),
            ("b", 4, "2024-01-01 00:00:00", None), ("b", 5, "2024-01-01 03:00:00", None)]
    out = running_stats(frame(spark, rows), "k", ["event_time", "id"],
                        {"s": ("sum", "x"), "m": ("max", "x"), "c": ("count", None)}).collect()
    assert sorted((r.id, r.s, r.m, r.c) for r in out) == [(1, 1, 1, 1), (2, 1, 1, 2), (3, 6, 5, 3), (4, None, None, 1), (5, None, None, 2)]


def test_stride_positions(spark):
    from streamlens.operators.frames import stride_sample
    rows = [("s", i, str(pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)), 0) for i in range(25)]
    df = frame(spark, rows).withColumnRenamed("k", "source").withColumnRenamed("id", "frame_id")
    got = stride_sample(df.select("source", "frame_id", "event_time"), 4).collect()
    assert sorted((r.frame_id, r.position) for r in got) == [(i, i) for i in range(0, 25, 4)]


def test_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 5}", i,
             str(pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=rnd.randint(0, 86400))),
             rnd.randint(0, 9)) for i in range(600)]
    out = running_stats(frame(spark, rows), "k", ["event_time", "id"],
                        {"c": ("count", None), "s": ("sum", "x"), "mx": ("max", "x"),
                         "mn": ("min", "x")}, chunk="hour")
    assert {r.id: (r.c, r.s, r.mx, r.mn) for r in out.collect()} == brute(rows)


def test_pairwise_fold(spark):
    rows = [("SD", 1, "2024-01-01 00:00:01", 8), ("SD", 2, "2024-01-01 00:00:02", 4),
            ("SD", 3, "2024-01-01 00:00:03", 2)]
    df = frame(spark, rows)
    out = agg.pairwise_avg_window(df, F.col("k"), "k", {"p": "x"}, "id").collect()
    assert out[0]["p"] == 4.0          # ((8 + 4) / 2 + 2) / 2
    mean = df.groupBy().agg(F.avg("x")).first()[0]
    assert abs(mean - 14 / 3) < 1e-12


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=40))
def test_pairwise_equals_python_fold(spark, xs):
    rows = [("k", i, str(pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=i % 30)), x)
            for i, x in enumerate(xs)]
    out = agg.pairwise_avg_window(frame(spark, rows), F.col("k"), "k", {"p": "x"}, "id",
                                  length="1 hour").first()["p"]
    order = sorted(rows, key=lambda r: (r[2], r[1]))
    acc = float(order[0][3])
    for r in order[1:]:
        acc = (acc + r[3]) / 2
    assert abs(out - acc) <= 1e-9 * max(1.0, abs(acc))


def test_null_and_empty_keys_stay_apart(spark):
    rows = [(None, 1, "2024-01-01 00:00:01", 1), ("", 2, "2024-01-01 00:00:02", 10),
            (None, 3, "2024-01-01 05:00:03", 100), ("", 4, "2024-01-01 07:00:04", 1000)]
    out = running_stats(frame(spark, rows), "k", ["event_time", "id"],
                        {"s": ("sum", "x")}, chunk="hour")
    got = {r.id: r.s for r in out.collect()}
    assert got == {1: 1, 2: 10, 3: 101, 4: 1010}
