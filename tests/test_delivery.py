"""Folds on streams, repeated deliveries, upserts, reads by offset, committing sinks."""
import os
import random

import pytest
from conftest import SF_SMALL
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from streamlens.operators import aggregates as agg
from streamlens.operators import topics as tv
from streamlens.plans import streams as S
from streamlens.session import scratch_path
from streamlens.sources import adapters as A
from streamlens.sources import io, payload_sink
from streamlens.sources import media as M
from streamlens.streaming import runner as R
from streamlens.streaming import upsert

ROW = "id string, k string, t timestamp, x int"


def _rows(spark, rows):
    return spark.createDataFrame([(i, k, f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}.{ms:03d}", x) for i, k, s, ms, x in rows],
                                 "id string, k string, t string, x int").withColumn("t", F.col("t").cast("timestamp"))


def _folds(rows, until):
    groups = {}
    for i, k, s, ms, x in sorted(rows, key=lambda r: (r[2], r[3], r[0])):
        if (s // 30 + 1) * 30 <= until:
            acc = groups.get((k, s // 30))
            groups[k, s // 30] = float(x) if acc is None else (acc + x) / 2
    return groups


def test_fold_on_a_stream_with_rows_out_of_order_and_a_hot_key(spark):
    rnd = random.Random(4)
    rows = [(f"r{n}", rnd.choice(["hot", "hot", "a", None]), s, rnd.choice([0, 0, 5, 999]), rnd.randint(0, 4000))
            for n, s in enumerate(sorted(rnd.randint(0, 400) for _ in range(500)))]
    late = [rnd.randint(-30, 30) for _ in rows]  # arrival differs from event order by less than the delay
    arrival = [r for _, r in sorted(zip([n + d for n, d in enumerate(late)], rows), key=lambda p: p[0])]
    folder, out, ckpt = (scratch_path(spark, f"t-fold-{x}") for x in ("in", "out", "ckpt"))
    for part in (arrival[:170], arrival[170:330], arrival[330:]):
        _rows(spark, part).repartition(3).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(ROW).parquet(folder).withWatermark("t", "1 minute")
        got = R.run_to_end(spark, agg.pairwise_avg_closed(stream, F.coalesce("k", F.lit("none")), "k", {"avg": "x"}, "id",
                                                          time_col="t"), "t-fold", checkpoint=ckpt, out=out)
    until = max(r[2] + r[3] / 1000 for r in rows) - 60
    want = {(k or "none", w): v for (k, w), v in _folds(rows, until).items()}
    found = {(r.k, r.window_start.minute * 2 + r.window_start.second // 30): r.avg for r in got.collect()}
    assert found.keys() == want.keys() and len(want) > 20
    assert all(found[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_fold_of_a_batch_equals_the_ranked_form(spark):
    rnd = random.Random(5)
    df = _rows(spark, [(f"r{n}", "k", rnd.randint(0, 90), 0, rnd.randint(0, 9)) for n in range(60)])
    a = agg.pairwise_avg_closed(df, F.col("k"), "k", {"avg": "x"}, "id", time_col="t").orderBy("window_start").collect()
    b = agg.pairwise_avg_window(df, F.col("k"), "k", {"avg": "x"}, "id", time_col="t").orderBy("window_start").collect()
    assert [(r.window_start, pytest.approx(r.avg)) for r in a] == [(r.window_start, r.avg) for r in b]


def test_redelivered_ids_are_dropped_and_their_state_is_evicted(spark):
    root, ckpt, out = (scratch_path(spark, f"t-once-{x}") for x in ("topics", "ckpt", "out"))
    msgs = A.transaction_messages(spark, SF_SMALL)
    kept = []
    for part in io.time_slices(msgs, 3):
        io.land_messages(part.unionByName(part.where("offset % 3 = 0")), root, "transactions")
        stream = S.delivered_once(io.read_topic(spark, "transactions", root=root), "transactions",
                                  S.TOTAL_FIELDS["transactions"], "1 hour")
        q = R.start(stream.select("transaction_id"), "append", out=out, checkpoint=ckpt)
        R.finish(q, 300)
        kept.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    ids = [r.transaction_id for r in spark.read.parquet(out).collect()]
    assert len(ids) == len(set(ids)) == S.jobs.processed_transactions(msgs).count()
    assert kept[-1] < len(ids) / 3  # ids behind the watermark are forgotten


def _upsert(spark, path, batches, buckets=4, replay=()):
    table = upsert.Table(spark, path, spark.createDataFrame([], "k string, v int").schema, ["k"], buckets)
    sink = upsert.upsert_sink(table)
    for n, rows in enumerate(batches):
        for _ in range(2 if n in replay else 1):
            sink(spark.createDataFrame(rows, "k string, v int"), n)
    return table


def test_upsert_keeps_one_row_per_key_and_removes_old_files(spark):
    rnd = random.Random(6)
    batches = [[(k, rnd.randint(0, 99)) for k in rnd.sample(["a", "b", "c", "d", "e", None, "é"], rnd.randint(0, 5))] for _ in range(9)]
    path = scratch_path(spark, "t-upsert")
    table = _upsert(spark, path, batches, replay=(2, 5, 8))
    want = {k: v for rows in batches for k, v in rows}
    got = table.read()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.items(), key=str)
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()
    used = {*table.manifest().items(), *table.manifest(len(batches) - 1).items()}
    there = {(int(b.split("=")[1]), int(n.split("=")[1])) for n in os.listdir(path) if n.startswith("batch=")
             for b in os.listdir(f"{path}/{n}") if b.startswith("upsert_bucket")}
    assert there <= used and len(os.listdir(f"{path}/manifests")) <= 4  # two and their checksums at most


def test_upsert_rewrites_only_touched_buckets(spark):
    path = scratch_path(spark, "t-upsert")
    table = _upsert(spark, path, [[(f"k{i}", 0) for i in range(200)], [("k7", 1)]], buckets=8)
    state = table.manifest()
    assert sorted(state.values()) == [0] * 7 + [1] and table.read().count() == 200
    assert table.read().where("k = 'k7'").first().v == 1
    with pytest.raises(ValueError):
        upsert.Table(spark, path, table.schema, ["k"], 16).read()


def test_update_stream_upserts(spark):
    root, out, ckpt = (scratch_path(spark, f"t-up-{x}") for x in ("topics", "out", "ckpt"))
    for part in io.time_slices(A.transaction_messages(spark, SF_SMALL), 2):
        io.land_messages(part, root, "transactions")
        totals = S.totals(io.read_topic(spark, "transactions", root=root), "transactions")
        got = R.run_to_end(spark, totals, "t-up", "upsert", ["user_id"], ckpt, out)
    want = agg.user_totals(S.jobs.processed_transactions(A.transaction_messages(spark, SF_SMALL)))
    assert sorted(got.collect()) == sorted(want.collect())


def _offset_rows(spark, n=1000):
    return spark.range(n).selectExpr(
        "cast(id as string) as key", "concat('v', id) as value", "'t' as topic", "cast(id % 3 as int) as partition",
        "id div 3 + if(id % 3 = 1, 1000000, 0) as offset", "timestamp'2024-01-01 00:00:00' as timestamp")


def test_offset_ranges_read_their_files_only(spark):
    root = scratch_path(spark, "t-offsets")
    rows = _offset_rows(spark)
    io.land_offsets(rows.where("id % 2 = 0") if "id" in rows.columns else rows.where("cast(key as long) % 2 = 0"), root, "t", 50)
    io.land_offsets(rows.where("cast(key as long) % 2 = 1"), root, "t", 50)  # a second landing shares blocks
    got = io.read_offsets(spark, "t", {0: 60, 1: 1_000_010}, {0: 90, 1: 1_000_020}, root=root)
    want = rows.where("partition = 0 and offset between 60 and 89 or partition = 1 and offset between 1000010 and 1000019")
    assert sorted(r.value for r in got.collect()) == sorted(r.value for r in want.collect())
    assert len(got.inputFiles()) == 4  # one block of two partitions in two landings
    assert io.read_offsets(spark, "t", {5: 0}, {5: 10}, root=root).count() == 0
    assert io.read_offsets(spark, "t", {0: 9}, {0: 9}, root=root).count() == 0
    first = io.read_first(spark, ["t"], 10, root)
    assert len(first.inputFiles()) == 2
    assert [r.offset for r in tv.first_messages(first, 10).orderBy("offset").collect()] == list(range(10))
    every = io.read_first(spark, ["t"], 5000, root)
    assert sorted(r.value for r in every.collect()) == sorted(r.value for r in rows.collect())


def test_rows_without_offset_are_refused(spark):
    with pytest.raises(PySparkException):
        io.land_offsets(_offset_rows(spark, 5).withColumn("offset", F.lit(None).cast("long")), scratch_path(spark, "t-o"), "t")


def _files(path):
    return sorted(f for d, _, names in os.walk(path) for f in names
                  if "/_" not in d[len(path):] and not f.startswith(("_", ".")))


def test_payload_sink_commits_once_and_a_failed_job_leaves_nothing(spark):
    spark.dataSource.register(payload_sink.PayloadFiles)
    rows = spark.range(20).selectExpr("concat('f', id, '.bin') as name", "cast(concat('x', id) as binary) as data").repartition(4)
    path = scratch_path(spark, "t-sink")
    rows.write.format("payload_files").option("path", path).mode("append").save()
    assert _files(path) == sorted(f"f{i}.bin" for i in range(20))
    bad = rows.withColumn("data", F.when(F.col("name") == "f7.bin", F.raise_error(F.lit("no"))).otherwise(F.col("data")))
    other = scratch_path(spark, "t-sink")
    with pytest.raises(PySparkException):
        bad.write.format("payload_files").option("path", other).mode("append").save()
    assert _files(other) == []
    with pytest.raises(PySparkException):  # a name that leaves the folder
        rows.withColumn("name", F.lit("../x")).write.format("payload_files").option("path", other).mode("append").save()
    assert _files(other) == []


def test_payload_stream_replay_changes_nothing(spark, tmp_path):
    writer = payload_sink.StreamWriter(str(tmp_path))
    sent = [writer.write(iter([("a", b"1"), ("b", None)])), writer.write(iter([("c", b"3")]))]
    writer.commit(sent, 0)
    before = {f: os.path.getmtime(f"{d}/{f}") for d, _, n in os.walk(tmp_path) for f in n}
    again = [writer.write(iter([("a", b"1"), ("c", b"3")]))]
    writer.commit(again, 0)
    assert {f: os.path.getmtime(f"{d}/{f}") for d, _, n in os.walk(tmp_path) for f in n} == before
    assert _files(str(tmp_path)) == ["a", "c"]
    writer.abort([writer.write(iter([("z", b"9")])), None], 1)
    assert _files(str(tmp_path)) == ["a", "c"]


def test_payload_stream_equals_the_batch_list(spark):
    from streamlens.plans.catalog import QUERIES
    got = QUERIES["export_payload_stream"](spark, SF_SMALL).collect()
    want = QUERIES["export_payload"](spark, SF_SMALL).select("name", "bytes_written").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_safe_names_are_used(spark):
    row = spark.createDataFrame([("1", "../../x", bytearray(b"d"))], "id string, name string, data binary")
    assert "/" not in row.select(M.stored_name(F.col("id"), F.col("name"), F.col("data"))).first()[0]


def test_reject_counts_per_batch(spark):
    from streamlens.operators.parse import accepted, parse_transactions
    from streamlens.streaming import rejects
    good = [r.value for r in A.transaction_messages(spark, SF_SMALL).limit(9).collect()]
    bad = ["{", "[1]", "{}", good[0].replace('"amount":', '"amount":"x","was":')]
    root, out, ckpt = (scratch_path(spark, f"t-counts-{x}") for x in ("topics", "out", "ckpt"))
    counts = rejects.RejectCounts("transactions")
    spark.streams.addListener(counts)
    try:
        for values in (good[:4] + bad, good[4:], bad[:1] * 3):
            io.write_topic(spark.createDataFrame([(v, v) for v in values], "key string, value string").coalesce(1),
                           "transactions", root=root)
            parsed = rejects.observed(parse_transactions(io.read_topic(spark, "transactions", root=root), require_time=True),
                                      "transactions")
            q = R.start(accepted(parsed), "append", out=out, checkpoint=ckpt)
            R.finish(q, 300)
            assert counts.wait(q.runId)
    finally:
        spark.streams.removeListener(counts)
    per_batch = {}
    for r in counts.frame(spark).collect():
        per_batch.setdefault(r.batch_id, {})[r.reason] = r.n
    assert [per_batch[b] for b in sorted(per_batch)] == [
        {"accepted": 4, "malformed_json": 1, "not_object": 1, "missing:transaction_id": 1, "bad_type:amount": 1},
        {"accepted": 5}, {"malformed_json": 3}]
    assert spark.read.parquet(out).count() == 9


def test_watched_folder_in_byte_bounded_batches_with_archive(spark):
    root, archive = scratch_path(spark, "t-watch"), scratch_path(spark, "t-archive")
    out, ckpt = scratch_path(spark, "t-watch-out"), scratch_path(spark, "t-watch-ckpt")
    rows = spark.range(12).selectExpr("cast(id as string) as id", "concat('f', id, '.txt') as name",
                                      "cast(repeat('x', 1000) as binary) as data")

    def run():
        files = M.ingest_files(spark, root, stream=True, max_bytes=3000, archive=archive)
        q = R.start(files.select("filename", "file_size"), "append", out=out, checkpoint=ckpt)
        R.finish(q, 300)
        return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    M.export_payloads(rows, root, "id", "name", F.col("data"))
    batches = run()
    assert sum(batches) == 12 and len(batches) >= 4 and max(batches) <= 3
    M.export_payloads(rows.withColumn("id", F.concat("id", F.lit("b"))), root, "id", "name", F.col("data"))
    assert sum(run()) == 12
    assert spark.read.parquet(out).count() == 24
    assert len(_files(archive)) >= 12 and len(_files(root)) + len(_files(archive)) == 24
