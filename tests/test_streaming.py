import io as _io
import os
import time
from contextlib import redirect_stdout

import pytest
from conftest import SF_SMALL, msgs
from pyspark.sql import functions as F
from streamlens.operators import running as run
from streamlens.plans import jobs
from streamlens.plans import streams as S
from streamlens.session import scratch_path
from streamlens.sources import adapters as A
from streamlens.sources import io
from streamlens.streaming import runner as R
from streamlens.streaming import running_batches as RB


def _txn_rows(spark):
    return A.transaction_messages(spark, SF_SMALL)


def _paths(spark, name):
    return {k: scratch_path(spark, f"{name}-{k}") for k in ("out", "state", "checkpoint")}


def test_time_slices_keep_every_message(spark):
    rows = [(f"k{i}", "v", "t", 0, i, None if i % 5 == 0 else f"2024-01-0{1 + i % 4} 00:00:0{i % 7}") for i in range(40)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, t string") \
        .withColumn("timestamp", F.col("t").cast("timestamp"))
    for source, n in ((df, 4), (df.where("t is null"), 3), (df.limit(0), 2), (df, 1)):
        parts = io.time_slices(source, n)
        assert len(parts) == n and sum(p.count() for p in parts) == source.count()
        root = scratch_path(spark, "t-slices")
        for p in parts:
            io.land_messages(p, root, "t")
        assert io.read_topic(spark, "t", root=root, stream=False).count() == source.count()
    newest = [p.agg(F.max("timestamp")).first()[0] for p in io.time_slices(df, 4)]
    assert newest == sorted(newest)


def test_landing_keeps_the_input_parallelism(spark):
    root = scratch_path(spark, "t-par")
    io.land_messages(_txn_rows(spark).repartition(6), root, "transactions")
    files = io.read_topic(spark, "transactions", root=root, stream=False).inputFiles()
    assert len(files) == 6


def test_same_key_across_batches_counts_up(spark):
    rows = _txn_rows(spark)
    p = _paths(spark, "t-running")
    root = scratch_path(spark, "t-files")
    for part in io.time_slices(rows, 4):
        io.land_messages(part, root, "transactions")
        S.run_running(io.read_topic(spark, "transactions", root=root), "transactions", **p)
    got = RB.rows(spark, "transactions", p["out"])
    want = run.running_records(jobs.processed_transactions(rows), "transactions")
    cols = ["transaction_id", "total_spent", "transaction_count", "last_updated"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_key_that_comes_back_after_ttl_counts_on(spark, monkeypatch):
    """Old rows with larger counters don't hide what came after the expiry."""
    now = [1_000_000.0]
    monkeypatch.setattr(time, "time", lambda: now[0])

    def batch(n, rows):
        return spark.range(rows).selectExpr(
            f"concat('t{n}-', id) as transaction_id", "'a' as user_id", "timestamp_ntz'2024-01-01 00:00:00' as event_time",
            "1.0D as final_amount", "cast(2 as decimal(18,2)) as spent")
    out, state = scratch_path(spark, "t-o"), scratch_path(spark, "t-s")
    sink = RB.running_sink("transactions", out, state, ttl_ms=60_000)
    sink(batch(0, 5), 0)
    for n in range(1, 8):
        now[0] += 3600 if n == 1 else 1
        sink(batch(n, 1), n)
    rows = RB.rows(spark, "transactions", out).where("transaction_id not like 't0%'").orderBy("transaction_id").collect()
    assert [(r.transaction_count, r.total_spent) for r in rows] == [(n, 2.0 * n) for n in range(1, 8)]


def test_running_state_replay_and_ttl(spark):
    schema = "transaction_id string, user_id string, event_time timestamp_ntz, final_amount double, spent decimal(18,2)"

    def batch(n, users="ab"):
        return spark.createDataFrame([(f"t{n}{u}", u, None, 1.0, None if n == 1 else 2) for u in users],
                                     "transaction_id string, user_id string, t string, final_amount double, spent long") \
            .selectExpr("transaction_id", "user_id", "cast(t as timestamp_ntz) as event_time", "final_amount",
                        "cast(spent as decimal(18,2)) as spent").to(spark.createDataFrame([], schema).schema)
    out, state = scratch_path(spark, "t-o"), scratch_path(spark, "t-s")
    sink = RB.running_sink("transactions", out, state)
    for n in range(8):
        for _ in range(2 if n in (2, 5, 6) else 1):  # delivered twice
            sink(batch(n), n)
    rows = RB.rows(spark, "transactions", out).where("user_id = 'a'").orderBy("transaction_id").collect()
    assert [r.transaction_count for r in rows] == list(range(1, 9))
    assert [r.total_spent for r in rows] == [2, 2, 4, 6, 8, 10, 12, 14]  # the NULL amount does not count
    late = RB.running_sink("transactions", out, state, ttl_ms=1)
    time.sleep(0.01)
    late(batch(8), 8)
    again = RB.rows(spark, "transactions", out).where("transaction_id = 't8a'").first()
    assert again.transaction_count == 1  # idle keys are forgotten


def test_running_state_reads_and_rewrites_touched_buckets_only(spark):
    def batch(users):
        return users.selectExpr("concat('t', id, '-', u) as transaction_id", "u as user_id",
                                "timestamp_ntz'2024-01-01 00:00:00' as event_time", "1.0D as final_amount",
                                "cast(1 as decimal(18,2)) as spent")
    out, state = scratch_path(spark, "t-o"), scratch_path(spark, "t-s")
    sink = RB.running_sink("transactions", out, state)
    sink(batch(spark.range(20_000).selectExpr("id", "concat('idle', id) as u")), 0)
    size = lambda: {d: sum(os.path.getsize(f"{p}/{f}") for p, _, n in os.walk(f"{state}/table/{d}") for f in n)
                    for d in os.listdir(f"{state}/table") if d.startswith("batch=")}
    whole = sum(size().values())
    for n in range(1, 6):
        sink(batch(spark.range(2).selectExpr("id", "concat('idle', id) as u")), n)
        assert size()[f"batch={n}"] < whole / 10  # two of 32 buckets
    assert sum(size().values()) < whole * 1.3  # superseded buckets are removed
    rows = RB.rows(spark, "transactions", out).where("user_id = 'idle1'").collect()
    assert sorted(r.transaction_count for r in rows) == [1, 2, 3, 4, 5, 6]


def test_late_rows_dropped_and_restart(spark):
    from streamlens.operators import aggregates as agg
    from streamlens.plans.catalog import QUERIES
    late = QUERIES["late_data"](spark, SF_SMALL)
    batch = agg.category_window(jobs.processed_transactions(_txn_rows(spark)))
    cols = ["window_start", "category", "total_amount", "transaction_count"]
    assert sorted(late.select(*cols).collect()) == sorted(batch.select(*cols).collect())


def test_fanout_replay_has_no_duplicates(spark):
    root = scratch_path(spark, "t-fan")
    sink = S.fanout_sink(root)
    batch = jobs.processed_transactions(_txn_rows(spark))
    for _ in range(2):
        sink(batch, 0)
    sink(batch.limit(1), 1)
    back = io.read_topic(spark, ["processed_transactions", "high_value_transactions"], root=root, stream=False)
    counts = {r.topic: r["count"] for r in back.groupBy("topic").count().collect()}
    assert counts["processed_transactions"] == batch.count() + 1


def test_update_log_replay_has_no_duplicates(spark):
    rows = _txn_rows(spark)
    root, out = scratch_path(spark, "t-log"), scratch_path(spark, "t-log-out")
    io.land_messages(rows, root, "transactions")
    totals = S.totals(io.read_topic(spark, "transactions", root=root), "transactions")
    once = R.run_to_end(spark, totals, "t-log", "update", out=out).count()
    again = R.run_to_end(spark, totals, "t-log", "update", out=out).count()  # a new checkpoint: batch 0 again
    assert once == again > 0


def test_poison_rows_pass_running_and_window_streams(spark):
    good = [r.value for r in _txn_rows(spark).limit(20).collect()]
    bad = [good[0].replace('"amount":', f'"amount":{x},"was":') for x in ("1e300", '"Infinity"', '"NaN"', "null")]
    bad.append(good[0].replace('"timestamp":"', '"timestamp":"soon'))
    root = scratch_path(spark, "t-poison")
    io.land_messages(msgs(spark, good + bad), root, "transactions")
    p = _paths(spark, "t-poison")
    S.run_running(io.read_topic(spark, "transactions", root=root), "transactions", **p)
    want = jobs.processed_transactions(msgs(spark, good)).count()
    assert RB.rows(spark, "transactions", p["out"]).count() == want
    win = S.windowed(io.read_topic(spark, "transactions", root=root), "transactions")
    assert R.run_to_end(spark, win, "t-pw", "update", S.window_keys("transactions")) \
        .agg(F.coalesce(F.sum("transaction_count"), F.lit(0))).first()[0] == want


def test_start_job_runs_three_queries(spark):
    root = scratch_path(spark, "t-job-topics")
    io.land_messages(_txn_rows(spark).repartition(3), root, "transactions")
    out_root = scratch_path(spark, "t-job-out")
    qs = S.start_job(spark, "transactions", checkpoint_root=scratch_path(spark, "t-job-ckpt"),
                     source={"root": root}, sink={"root": out_root},
                     windows_out=scratch_path(spark, "t-job-win"), available_now=True,
                     max_per_trigger=1)
    for q in qs:
        R.finish(q, 300)
    processed = io.read_topic(spark, "processed_transactions", root=out_root, stream=False)
    running = io.read_topic(spark, "user_aggregations", root=out_root, stream=False)
    expected = jobs.processed_transactions(_txn_rows(spark)).count()
    assert processed.count() == expected and running.count() == expected


def test_stop_after_a_time_is_marked(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    q = R.start(rate.select("value"), "append", out=scratch_path(spark, "t-l2"),
                checkpoint=scratch_path(spark, "t-l2c"), available_now=False)
    assert R.finish(q, 6) is False and not q.isActive
    slow = io.read_topic(spark, "transactions", root=_landed(spark))
    wait = F.udf(lambda v: (time.sleep(0.2), v)[1])
    with pytest.raises(R.Stopped) as e:
        R.run_to_end(spark, slow.select(wait("key").alias("key")), "t-l2", timeout_s=2)
    assert e.value.result.count() < _txn_rows(spark).count()


def _landed(spark):
    root = scratch_path(spark, "t-land")
    io.land_messages(_txn_rows(spark).coalesce(1), root, "transactions")
    return root


def test_console_sink_runs_on_its_trigger(spark):
    win = S.windowed(io.read_topic(spark, "transactions", root=_landed(spark)), "transactions")
    with redirect_stdout(_io.StringIO()):
        q = R.start(win, "console", checkpoint=scratch_path(spark, "t-con"), processing_time="1 second",
                    available_now=False)
        assert R.finish(q, 8) is False
    assert q.recentProgress and not q.isActive


def test_no_scratch_folder_is_invented_on_a_cluster():
    from streamlens import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Fake:
        class conf:
            get = staticmethod(lambda k, d=None: None)
        sparkContext = Context()
    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())
    assert os.path.isabs("/")
