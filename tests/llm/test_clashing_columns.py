"""Input columns named like an operator's helper columns come back as they were."""
from pyspark.sql import functions as F
from streamlens.llm import pii, sharding, simhash, url_filter
from streamlens.llm.common import set_aside


def test_set_aside(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`__ID` int, aside_0 int, x int")
    same, now, back = set_aside(df, "other")
    assert same is df and now("x") == "x" and back(df) is df
    out, now, back = set_aside(df, "__id", "aside_1")
    assert out.columns == ["aside_2", "aside_0", "x"] and now("__id") == "aside_2"
    assert back(out.withColumn("more", F.lit(4))).collect()[0].asDict() == {"__ID": 1, "aside_0": 2, "x": 3, "more": 4}


def test_url_filter(spark):
    rows = spark.createDataFrame([("http://a.b/x", "2024-01-05", 1, "k")], "url string, fetch_date string, b int, `__day` string")
    entries = spark.createDataFrame([("block", "a.b", "2024-01-01", "add")], "list string, pattern string, date string, action string")
    got = url_filter.judge(rows, entries).collect()[0]
    assert (got.verdict, got.b, got["__day"]) == ("block", 1, "k")
    got = url_filter.judge(rows.withColumnRenamed("b", "n").withColumnRenamed("fetch_date", "b"), entries, date_col="b").collect()[0]
    assert (got.verdict, got.b, got.n) == ("block", "2024-01-05", 1)


def test_pii(spark):
    rows = spark.createDataFrame([(1, "mail me@here.org", 7, 8, "n"), (2, "plain", 1, 2, "m")],
                                 "doc_id int, text string, `__found` long, `__list` long, `__new` string")
    got = {r.doc_id: r for r in pii.replace_entities(rows, "key", count_col="n").collect()}
    assert (got[1]["__found"], got[1]["__list"], got[1]["__new"], got[1].n) == (7, 8, "n", 1)
    assert "me@here.org" not in got[1].text and got[2].text == "plain" and got[2]["__new"] == "m"
    own = rows.select("doc_id", F.col("text").alias("__new"))
    assert "me@here.org" not in pii.replace_entities(own, "key", text_col="__new").where("doc_id = 1").first()["__new"]


def test_sharding(spark):
    rows = spark.range(20).selectExpr("id", "id * 2 as `__p`", "'s' as `__start`", "id as `__at`", "-id as `__order`", "id as `__tie`")
    out = sharding.feistel_shards(rows, 4, order_by=["__order"]).collect()
    assert all(r["__p"] == 2 * r.id and r["__at"] == r["__tie"] == r.id and r["__order"] == -r.id and r["__start"] == "s" for r in out)
    assert sorted(r.id for r in out) == list(range(20)) and [r.id for r in sorted(out, key=lambda r: r.row_number)] == list(range(19, -1, -1))


def test_shards_and_slots_equal_a_scalar_feistel(spark):
    out = sharding.feistel_shards(spark.range(101), 8, seed=3, order_by=["id"]).collect()
    import numpy as np
    for r in out:
        at = int(sharding.permute(np.array([r.row_number]), 101, 3)[0])  # one row number at a time
        assert (r.row_number, r.shard, r.slot) == (r.id, at % 8, at // 8)
    assert sorted((r.shard, r.slot) for r in out) == sorted((p % 8, p // 8) for p in range(101))


def test_simhash_keep_one(spark):
    text = "one two three four five six seven eight"
    rows = spark.createDataFrame([(1, text, "a", 5), (2, text, "b", 6)], "doc_id int, text string, `__id` string, `__hash` int")
    got = simhash.keep_one(rows).collect()
    assert [tuple(r) for r in got] == [(1, text, "a", 5)] and got[0].__fields__ == rows.columns
