from pyspark.sql import functions as F

from streamlens.operators import aggregates as agg
from streamlens.operators import transactions as to


def txns(spark, rows):
    return spark.createDataFrame(
        rows, "transaction_id string, user_id string, category string, amount double, "
              "event_time timestamp_ntz")


def test_high_value_boundary_and_nan(spark):
    df = txns(spark, [("a", "u", "books", 100.0, None), ("b", "u", "books", 100.01, None),
                      ("c", "u", "books", float("nan"), None)])
    assert [r["transaction_id"] for r in to.high_value(df).collect()] == ["b"]


def test_discount_half_cent(spark):
    df = txns(spark, [("a", "u", "electronics", 2.50, None), ("b", "u", "toys", 2.50, None),
                      ("c", "u", "books", 150.0, None), ("d", "u", "clothing", 150.0, None)])
    got = {r["transaction_id"]: (r["final_amount"], r["discount_applied"])
           for r in to.enrich(df).collect()}
    assert got["a"] == (2.38, 0.95)       # 2.375 rounds half-up
    assert got["b"] == (2.5, 1.0)
    assert got["c"] == (135.0, 0.9)
    assert got["d"] == (138.0, 0.92)


def test_to_json_nulls(spark):
    df = txns(spark, [("a", None, "books", 1.0, None)])
    v = to.to_json_value(df, ["transaction_id", "user_id"]).collect()[0]["value"]
    assert v == '{"transaction_id":"a","user_id":null}'


def test_single_row_window(spark):
    df = txns(spark, [("a", "u", "books", 150.0, None)]).withColumn(
        "event_time", F.lit("2024-01-01 00:00:10").cast("timestamp_ntz"))
    out = agg.category_window(to.enrich(df)).collect()
    assert len(out) == 1
    assert out[0]["transaction_count"] == 1 and out[0]["total_amount"] == 135.0
    assert str(out[0]["window_start"]) == "2024-01-01 00:00:00"


def test_very_high_split(spark):
    df = txns(spark, [("a", "u", "books", 500.0, None), ("b", "u", "books", 500.01, None),
                      ("c", "u", "books", 1999.99, None)])
    assert sorted(r["transaction_id"] for r in to.very_high_value(df).collect()) == ["b", "c"]
