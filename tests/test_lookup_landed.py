"""Lookup tables that change between batches, and one parse for all branches."""
import pytest
from conftest import SF_SMALL, msgs
from pyspark.sql import functions as F
from streamlens.operators.parse import accepted, parse_messages
from streamlens.plans import streams as S
from streamlens.session import scratch_path
from streamlens.sources import adapters as A
from streamlens.sources import io
from streamlens.streaming import lookup as L
from streamlens.streaming import runner as R

SCHEMA = "name string, note string, fps int"


def _table(spark, *versions):
    t = L.Lookup(spark, scratch_path(spark, "t-lookup"), SCHEMA, "name")
    for v in versions:
        t.publish(spark.createDataFrame(v, SCHEMA))
    return t


def test_versions_and_refused_keys(spark):
    t = _table(spark)
    assert t.newest() is None and t.read(None).count() == 0
    assert t.publish(spark.createDataFrame([("a", "x", 1)], SCHEMA)) == 1
    for bad in ([("a", "x", 1), ("a", "y", 2)], [(None, "x", 1)]):
        with pytest.raises(ValueError):
            t.publish(spark.createDataFrame(bad, SCHEMA))
    assert t.newest() == 1
    assert t.publish(spark.createDataFrame([], SCHEMA)) == 2 and t.read(2).count() == 0


def test_a_replayed_batch_keeps_its_version(spark):
    t = _table(spark, [("a", "old", 1), ("b", None, None)])
    out = scratch_path(spark, "t-lookup-out")
    sink = L.lookup_sink(t, out, "source", {"note": "none", "fps": 7})
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None), (4, "a")], "id int, source string")
    sink(rows, 0)
    t.publish(spark.createDataFrame([("a", "new", 2)], SCHEMA))
    sink(rows, 0)  # delivered again
    sink(rows, 1)
    got = sorted(map(tuple, spark.read.parquet(out).select(R.BATCH_ID, "id", "note", "fps", "lookup_version").fillna("NULL").collect()))
    assert got == sorted([(0, 1, "old", 1, 1), (0, 2, "NULL", None, 1), (0, 3, "none", 7, 1), (0, 4, "none", 7, 1), (0, 4, "old", 1, 1),
                          (1, 1, "new", 2, 2), (1, 2, "none", 7, 2), (1, 3, "none", 7, 2), (1, 4, "none", 7, 2), (1, 4, "new", 2, 2)])


def test_broadcast_only_below_the_measured_size(spark):
    t = _table(spark, [(f"n{i}", "x" * 50, i) for i in range(3000)])
    rows = spark.range(10).select(F.concat(F.lit("n"), "id").alias("source"), F.lit("mine").alias("note"))
    out = L.attach(rows, t.read(1), "source", "name", {})
    assert out.columns == ["source", "note", "fps"] and out.where("note like 'xxx%'").count() == 10
    plan = lambda: L.attach(rows, t.read(1), "source", "name", {})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        assert "BroadcastHashJoin" not in plan() and "SortMergeJoin" in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _landed(spark, kind, frame):
    topics, root, ckpt = (scratch_path(spark, f"t-landed-{k}") for k in ("in", "out", "ckpt"))
    names = S.JOB_TOPICS[kind][0]
    for t in names:
        io.land_messages(frame.where(F.col("topic") == t), topics, t)
    R.finish(S.start_landing([io.read_topic(spark, t, root=topics) for t in names], kind, root=root, checkpoint=ckpt))
    return root


@pytest.mark.parametrize("kind", ["transactions", "video_frames", "uploaded_files"])
def test_branches_read_their_columns_and_parse_nothing(spark, kind, capsys):
    make = {"transactions": A.transaction_messages, "video_frames": A.frame_messages, "uploaded_files": A.file_messages}[kind]
    frame = make(spark, SF_SMALL)
    root = _landed(spark, kind, frame)
    records = [S.read_landed(spark, root, kind, t) for t in S.JOB_TOPICS[kind][0]]
    _, running, windows = S.landed_branches(records, kind)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # the last batch is then one with data
    q = windows.writeStream.format("noop").outputMode("update").trigger(availableNow=True).option(
        "checkpointLocation", scratch_path(spark, "t-landed-q")).start()
    R.finish(q)
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    q.explain(True)
    plan = capsys.readouterr().out
    assert "Scan" in plan and "parse_json" not in plan.lower()
    payload = {"transactions": "payment_method", "video_frames": "source:", "uploaded_files": "file_hash"}[kind]
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and all(payload not in line.split("ReadSchema")[1] for line in scans)
    static = spark.read.schema(S._landed_schema(spark, kind)).parquet(root)
    want = accepted(parse_messages(frame, kind, keep=["topic"]))
    got = static.where("accepted").select(*want.columns)
    assert got.count() == want.count() > 0
    ident = S.RECORD_ID[kind]
    assert got.select("topic", ident, "event_time").exceptAll(want.select("topic", ident, "event_time")).count() == 0


def test_landed_rejects_are_the_quarantine(spark):
    frame = msgs(spark, ["{", "[1]", '{"amount": 1}', None])
    root = _landed(spark, "transactions", frame)
    got = S.landed_quarantine(spark, root, "transactions").collect()
    assert sorted((r.raw_value or "", r.reject_reason) for r in got) == [
        ("", "malformed_json"), ("[1]", "not_object"), ("{", "malformed_json"), ('{"amount": 1}', "missing:transaction_id")]
