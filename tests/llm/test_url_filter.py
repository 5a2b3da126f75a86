from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F
from streamlens.llm import url_filter
from streamlens.llm.queries import ORACLE, QUERIES


def brute(captures, entries):
    """Verdict and rule per capture, straight from the events."""
    events = {}
    for lst, pattern, day, action in entries:
        if None not in (lst, pattern, day, action):
            events.setdefault((lst, pattern), {}).setdefault(day, set()).add(action)
    out = []
    for _, host, path, day in captures:
        best = None
        for (lst, pattern), days in events.items():
            past = [d for d in days if host and day and d <= day]
            if not past or "remove" in days[max(past)]:
                continue
            h, _, p = pattern.partition("/")
            covers = host == h and (path + "/").startswith(p + "/") if p else host == h or host.endswith("." + h)
            if covers:
                key = (len(pattern), lst == "allow", max(past))
                if best is None or key > best[0]:
                    best = (key, lst, pattern)
        out.append(("none", None) if best is None else best[1:])
    return out


D = date(2024, 1, 1)
ENTRIES = [("block", "a.org", D, "add"), ("block", "a.org", D + timedelta(40), "remove"), ("block", "a.org", D + timedelta(90), "add"),
           ("allow", "x.a.org", D + timedelta(10), "add"), ("block", "x.a.org/p", D + timedelta(5), "add"),
           ("allow", "x.a.org/p", D + timedelta(5), "add"), ("allow", "x.a.org/p", D + timedelta(70), "remove"),
           ("block", "b.com", D, "add"), ("block", "b.com", D, "remove"), ("block", "org", D + timedelta(200), "add"),
           (None, "a.org", D, "add"), ("block", None, D, "add"), ("block", "q.net", None, "add"),
           ("block", "q.net", D + timedelta(3), "add"), ("block", "q.net", D + timedelta(3), "add")]
URLS = [("http://a.org/", "a.org", ""), ("https://U:p@X.A.ORG:80//p/q?x=/r#f", "x.a.org", "p/q"), ("http://x.a.org/pq", "x.a.org", "pq"),
        ("http://b.com", "b.com", ""), ("ftp://q.net./z", "q.net", "z"), ("nonsense", None, ""), (None, None, ""), ("http:///x", None, "")]


def test_against_brute_force(spark):
    caps = [(u, h, p, None if k == 300 else D + timedelta(k)) for u, h, p in URLS for k in (0, 5, 39, 40, 69, 70, 89, 90, 300, 201)]
    caps += caps[:7]
    df = spark.createDataFrame([(i, u, d, "old") for i, (u, _, _, d) in enumerate(caps)],
                               "page_id long, url string, fetch_date date, verdict string")
    e = spark.createDataFrame(ENTRIES, "list string, pattern string, date date, action string")
    got = {r.page_id: (r.verdict, r.rule) for r in url_filter.judge(df, e).collect()}
    assert [got[i] for i in range(len(caps))] == brute(caps, ENTRIES)
    assert {v for v, _ in got.values()} == {"allow", "block", "none"}
    assert {r.verdict for r in url_filter.judge(df, e.limit(0)).collect()} == {"none"}
    assert url_filter.judge(df.limit(0), e).count() == 0


def test_addresses_are_covered_as_a_whole_only(spark):
    urls = ["http://10.2.3.4/a/b", "http://9.9.3.4", "http://[2001:db8::1]:8080/x", "http://u@[2001:DB8::2]/x", "http://x.3.4/",
            "http://1.2.3.4.org/", "http://1.10.2.3.4/", "http://[2001/x", "http://300.1.1.1000/"]
    df = spark.createDataFrame([(i, u, D) for i, u in enumerate(urls)], "page_id long, url string, fetch_date date")
    e = spark.createDataFrame([("block", p, D, "add") for p in ("3.4", "4", "10.2.3.4/a", "[2001:db8::1]", "1", "1.1000", "db8::2]")],
                              "list string, pattern string, date date, action string")
    got = {r.page_id: (r.host, r.rule) for r in url_filter.judge(df, e).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("10.2.3.4", "10.2.3.4/a"), ("9.9.3.4", None), ("[2001:db8::1]", "[2001:db8::1]"), ("[2001:db8::2]", None), ("x.3.4", "3.4"),
        ("1.2.3.4.org", None), ("1.10.2.3.4", "3.4"), (None, None), ("300.1.1.1000", "1.1000")]


def test_sql_and_query_agree_on_odd_hosts(spark, tmp_path):
    urls = ["http://10.2.3.4/a/b", "http://[2001:db8::1]:80/x", "http://u:p@[::1]/x", "http://a[b].org/", "http://[x/", "http://a.b.c.d/",
            "http://1.2.3/", "http://a@b@c/", "http://u:p@", "http://u@/x", "http://:80/", "http://1.2.3.04./q", None, "http://a.org./", "x"] * 40
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    rel = con.execute(ORACLE["op9_url_filter"])
    names = [d[0] for d in rel.description]
    rows = QUERIES["op9_url_filter"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, rel.fetchall()))


def test_intervals(spark):
    e = spark.createDataFrame(ENTRIES, "list string, pattern string, date date, action string")
    rows = sorted((r.valid_from, r.valid_to) for r in url_filter.validity_intervals(e).where("pattern = 'a.org'").collect()
                  if r.valid_to is not None)
    assert rows == [(D, D + timedelta(40))]
    assert url_filter.validity_intervals(e).where("pattern = 'b.com'").count() == 0


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "http://a.org", D)], "page_id long, url string, fetch_date date")
    e = spark.createDataFrame(ENTRIES, "list string, pattern string, date date, action string")
    plan = url_filter.judge(df, e)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    rel = con.execute(ORACLE["op9_url_filter"])
    names = [d[0] for d in rel.description]
    df = QUERIES["op9_url_filter"](spark, sf)
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, rel.fetchall()))
    assert df.where(F.col("verdict") != "none").count() > 0
