import pytest
from pyspark.sql import functions as F

from streamlens.functions import columns as X
from streamlens.operators import aggregates as agg
from streamlens.operators import files as fo
from streamlens.operators import frames as vo


def one(spark, expr, value, ddl="string"):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_base64_edges(spark):
    assert one(spark, X.b64decode, "aGVs!bG8=") is None
    assert one(spark, X.b64decode, "aGVsbG8") == bytearray(b"hello")
    assert len(one(spark, X.b64encode, b"x" * 300, "binary")) == 400


@pytest.mark.parametrize("text,words,has", [("\t", 0, False), (" ", 0, False),
                                            ("", 0, False), ("a b c\n d", 4, True)])
def test_words(spark, text, words, has):
    assert one(spark, X.word_count, text) == words
    assert one(spark, X.has_text, text) is has


def test_resolution_and_orientation(spark):
    df = spark.createDataFrame([(640, 480), (639, 480), (640, 479), (1920, 1080), (1280, 720),
                                (300, 200), (400, 500)], "w int, h int")
    got = df.select("w", "h", X.resolution_class("w", "h").alias("c"),
                    X.orientation(F.col("w") / F.col("h")).alias("o")).collect()
    cls = {(r.w, r.h): r.c for r in got}
    assert cls[(1920, 1080)] == "HD" and cls[(1280, 720)] == "HD_Ready"
    assert cls[(640, 480)] == "SD" and cls[(639, 480)] == "Low"
    ori = {(r.w, r.h): r.o for r in got}
    assert ori[(300, 200)] == "square" and ori[(400, 500)] == "square"
    frames = df.withColumnRenamed("w", "frame_width").withColumnRenamed("h", "frame_height")
    assert vo.high_resolution(frames).count() == 3


def test_bad_payload_gives_unknown_key(spark):
    df = spark.createDataFrame(
        [("f1", "aGVs!bG8=", 640, 480, 10, "2024-01-01 00:00:01")],
        "frame_id string, frame_data string, frame_width int, frame_height int, "
        "frame_size_bytes long, t string").withColumn("event_time", F.col("t").cast("timestamp_ntz"))
    out = agg.resolution_window(vo.analyze(df)).collect()
    assert out[0]["resolution_category"] == "unknown"


def test_size_tiers_and_filter(spark):
    mib = 1024 * 1024
    df = spark.createDataFrame([(mib,), (mib + 1,), (10 * mib,), (100 * mib,), (1,)], "file_size long")
    tiers = [r[0] for r in df.select(X.size_tier("file_size")).collect()]
    assert tiers == ["medium", "medium", "large", "very_large", "small"]
    assert [r[0] for r in fo.large_files(df).collect()] == [mib + 1, 10 * mib, 100 * mib]


def test_file_name_rules(spark):
    df = spark.createDataFrame([("a.b.PDF",), ("noext",), ("x.rtf",), ("x.exe",)], "n string")
    got = df.select(X.file_type_of("n").alias("t"), X.is_client_allowed("n").alias("c")).collect()
    assert [r.t for r in got] == ["document", "unknown", "document", "unknown"]
    assert [r.c for r in got] == [True, False, False, False]


def test_human_size_and_preview(spark):
    df = spark.createDataFrame([(0,), (1023,), (1024,), (1536,), (1048576,)], "b long")
    assert [r[0] for r in df.select(X.human_size("b")).collect()] == [
        "0 Bytes", "1023 Bytes", "1 KB", "1.5 KB", "1 MB"]
    assert one(spark, X.text_preview, "x" * 200) == "x" * 200
    assert one(spark, X.text_preview, "x" * 201) == "x" * 200 + "..."


def test_quality_and_zero_guards(spark):
    meta = "struct<text_content:string,width:int,height:int,channels:int,frame_count:bigint,duration:double>"
    rows = [("v1", "video", 5, "c", (None, 1279, 0, None, 10, 0.0)),
            ("v2", "video", 5, "c", (None, 1280, 720, None, 10, 2.0)),
            ("i1", "image", 5, "c", (None, 1919, 0, 3, None, None)),
            ("i2", "image", 5, "c", (None, 1920, 1080, 1, None, None))]
    df = spark.createDataFrame(rows, f"file_id string, file_type string, file_size long, "
                                     f"file_content string, metadata {meta}")
    a = {r.file_id: r.analysis for r in fo.analyze(df).collect()}
    assert a["v1"].video_quality == "SD" and a["v1"].bitrate_estimate == 0 and a["v1"].aspect_ratio == 0
    assert a["v2"].video_quality == "HD" and a["v2"].bitrate_estimate == 20.0
    assert a["i1"].image_quality == "Medium" and a["i1"].aspect_ratio == 0
    assert a["i2"].image_quality == "High" and a["i2"].color_depth == 8
