"""URL filters by dated lists: validity intervals and an as-of join.

List entries are dated events ("add" or "remove" of a pattern on a list).  They
become validity intervals, and every capture is judged by the entries that were
active on its fetch date, not by today's list.

A pattern is a host suffix of whole labels ("example.org" covers
"a.example.org") or a host with a path prefix of whole segments
("a.org/x" covers "a.org/x/y").  Addresses have no suffixes: a host of four
decimal numbers or in brackets (IPv6) is covered as a whole only.  Of the active entries that cover a capture the
longest pattern wins, then an allow list over a block list, then the latest
start.  Everything is DataFrame functions.

The join is on the pattern and the month: a pattern that covers a third of all
captures is spread over its months (and split further by AQE), and no capture
meets the whole history of a pattern.

Edge cases: a URL that is NULL or has no host, a NULL fetch date and a capture
that no active entry covers get the verdict "none".  Entries with a NULL field
are ignored.  Of several events of a pattern, list and date, a removal wins.
Repeated captures are all returned.  Empty tables are fine on either side.
Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.llm.common import own_exchange, set_aside, without

_OUT = ("host", "verdict", "rule", "rule_from", "rule_to")


def url_host(url: Column) -> Column:
    """Lower-case host without user info, port and closing dot; NULL if none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?+(\[[^\]/?#@]*\]|[^/?#:@\[\]]+)", 1))
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def url_path(url: Column) -> Column:
    """Path segments without empty ones, query and fragment."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def is_address(host: Column) -> Column:
    """Whether a host is an IPv4 address or a bracketed IPv6 one."""
    return host.rlike(r"^(?:\[.*\]|(?:[0-9]{1,3}\.){3}[0-9]{1,3})$")


def covering_patterns(host: Column, segments: Column) -> Column:
    """All patterns that cover a URL: its host's suffixes and path prefixes."""
    labels = F.when(is_address(host), F.array(host)).otherwise(F.split(host, r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(F.sequence(F.lit(0), F.size(segments)), lambda i: i > 0),
                           lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))
    return F.concat(suffixes, prefixes)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from dated events (list, pattern,
    date, action); valid_to is exclusive, NULL while still active."""
    events = entries.select("list", "pattern", F.col("date").cast("date").alias("date"), "action").where(
        "list is not null and pattern is not null and date is not null and action is not null")
    daily = events.groupBy("list", "pattern", "date").agg(F.max("action").alias("action"))  # "remove" > "add"
    w = Window.partitionBy("list", "pattern").orderBy("date")
    return (daily.withColumn("valid_to", F.lead("date").over(w)).where("action = 'add'")
            .select("list", "pattern", F.col("date").alias("valid_from"), "valid_to"))


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", date_col: str = "fetch_date") -> DataFrame:
    """``captures`` plus ``host``, ``verdict`` (the list of the deciding entry,
    or "none"), ``rule`` (its pattern), ``rule_from`` and ``rule_to``."""
    captures, now, back = set_aside(without(captures, *_OUT), "__day", "__path", "__h", "__p", "__d", "b")
    url_col, date_col = now(url_col), now(date_col)
    day = F.col(f"`{date_col}`").cast("date")
    rows = captures.withColumns({"host": url_host(F.col(f"`{url_col}`")), "__day": day,
                                 "__path": F.array_join(url_path(F.col(f"`{url_col}`")), "/")})
    keys = (rows.where("host is not null and __day is not null")
            .select("host", F.col("__path").alias("path"), F.col("__day").alias("day")).distinct())
    span = keys.agg(F.min("day"), F.max("day")).first()
    active = validity_intervals(entries).select(
        "list", "pattern", "valid_from", "valid_to",
        F.greatest("valid_from", F.lit(span[0]).cast("date")).alias("lo"),
        F.least(F.date_sub("valid_to", 1), F.lit(span[1]).cast("date")).alias("hi")).where("lo <= hi")
    active = active.withColumn("month", F.explode(F.sequence(
        F.trunc("lo", "MM"), F.trunc("hi", "MM"), F.expr("interval 1 month"))))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    asked = keys.select("host", "path", "day", F.trunc("day", "MM").alias("month"),
                        F.explode(covering_patterns(F.col("host"), segments)).alias("pattern"))
    best = F.max(F.struct(F.length("pattern").alias("size"), (F.col("list") == "allow").alias("allow"), "valid_from",
                          "list", "pattern", "valid_to"))
    ruled = (asked.join(active, ["pattern", "month"]).where("day >= valid_from and (valid_to is null or day < valid_to)")
             .groupBy("host", "path", "day").agg(best.alias("b"))
             .select(F.col("host").alias("__h"), F.col("path").alias("__p"), F.col("day").alias("__d"), "b"))
    return back(rows.join(own_exchange(ruled, "__h"), (F.col("host") == F.col("__h")) & (F.col("__path") == F.col("__p"))
                      & (F.col("__day") == F.col("__d")), "left")
            .select(*[F.col(f"`{c}`") for c in captures.columns], "host",
                    F.coalesce("b.list", F.lit("none")).alias("verdict"), F.col("b.pattern").alias("rule"),
                    F.col("b.valid_from").alias("rule_from"), F.col("b.valid_to").alias("rule_to")))


# ---- the query's tables, derived from `pages` ------------------------------

HEX = "0123456789abcdef"


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages have no fetch date: page_id modulo 366 days after 2024-01-01."""
    return pages.select("page_id", "url", F.date_add(
        F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(366)).cast("int")).alias("fetch_date"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the pages' own hosts, parent domains and first path
    segments; dates and lists follow from digits of the pattern's MD5."""
    url = F.col("url")
    host, first = url_host(url), F.try_element_at(url_path(url), F.lit(1))
    labels = F.when(is_address(host), F.array(host)).otherwise(F.split(host, r"\."))
    parent = F.array_join(F.slice(labels, -2, 2), ".")
    patterns = pages.select(F.explode(F.array(host, F.when(F.size(labels) > 1, parent), F.concat(host, F.lit("/"), first)))
                            .alias("pattern")).where("pattern is not null").distinct()

    def digit(k: int) -> Column:
        return F.instr(F.lit(HEX), F.substring(F.md5(F.col("pattern").cast("binary")), k, 1)) - 1
    added = F.date_add(F.lit("2024-01-01").cast("date"), 16 * digit(1) + digit(2))
    removed = F.date_add(added, 1 + 8 * digit(3) + digit(4))
    again = F.date_add(removed, 1 + 4 * digit(5))
    event = lambda d, a: F.struct(d.alias("date"), F.lit(a).alias("action"))
    return (patterns.where(digit(8) < 10)
            .withColumn("e", F.explode(F.array(event(added, "add"), event(removed, "remove"),
                                               F.when(digit(6) < 8, event(again, "add")))))
            .where("e is not null")
            .select(F.when(digit(7) < 11, "block").otherwise("allow").alias("list"), "pattern", "e.date", "e.action"))


ORACLE = f"""
WITH s AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(((page_id % 366) + 366) % 366 AS INTEGER) AS fetch_date,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) AS authority,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segs
  FROM pages),
h AS (
  SELECT page_id, url, fetch_date, segs, nullif(rtrim(lower(
           CASE WHEN starts_with(server, '[') AND contains(server, ']') THEN string_split(server, ']')[1] || ']'
                WHEN contains(string_split(server, ':')[1], '[') OR contains(string_split(server, ':')[1], ']') THEN regexp_extract(server, '^[^\\[\\]:]*')
                ELSE string_split(server, ':')[1] END), '.'), '') AS host
  FROM (SELECT *, string_split(authority, '@')[-1] AS server FROM s)),
u AS (
  SELECT *, CASE WHEN starts_with(host, '[')
                   OR (len(string_split(host, '.')) = 4 AND len(list_filter(string_split(host, '.'), lambda x:
                       len(x) BETWEEN 1 AND 3 AND x = regexp_replace(x, '[^0-9]', '', 'g'))) = 4)
                 THEN [host] ELSE string_split(host, '.') END AS labels FROM h),
p AS (
  SELECT DISTINCT unnest([host, CASE WHEN len(labels) > 1
                                     THEN array_to_string(labels[-2:], '.') END,
                          host || '/' || segs[1]]) AS pattern FROM u WHERE host IS NOT NULL),
d AS (
  SELECT pattern, list_transform(range(1, 9), lambda k: instr('{HEX}', substr(md5(pattern), CAST(k AS INTEGER), 1)) - 1) AS x
  FROM p WHERE pattern IS NOT NULL),
a AS (
  SELECT pattern, x, CASE WHEN x[7] < 11 THEN 'block' ELSE 'allow' END AS list,
         DATE '2024-01-01' + CAST(16 * x[1] + x[2] AS INTEGER) AS added, CAST(1 + 8 * x[3] + x[4] AS INTEGER) AS days,
         CAST(1 + 4 * x[5] AS INTEGER) AS gap FROM d WHERE x[8] < 10),
i AS (
  SELECT list, pattern, added AS valid_from, added + days AS valid_to FROM a
  UNION ALL SELECT list, pattern, added + days + gap, NULL FROM a WHERE x[6] < 8),
m AS (
  SELECT page_id, url, fetch_date, unnest(list_concat(
           list_transform(range(1, len(labels) + 1),
                          lambda k: array_to_string(labels[k:], '.')),
           list_transform(range(1, len(segs) + 1), lambda k: host || '/' || array_to_string(segs[1:k], '/')))) AS pattern
  FROM u WHERE host IS NOT NULL AND fetch_date IS NOT NULL),
r AS (
  SELECT DISTINCT ON (page_id, url, fetch_date) page_id, url, fetch_date, list, pattern, valid_from, valid_to
  FROM m JOIN i USING (pattern) WHERE fetch_date >= valid_from AND (valid_to IS NULL OR fetch_date < valid_to)
  ORDER BY page_id, url, fetch_date, length(pattern) DESC, list = 'allow' DESC, valid_from DESC)
SELECT u.page_id, u.url, u.fetch_date, u.host, coalesce(r.list, 'none') AS verdict, r.pattern AS rule,
       r.valid_from AS rule_from, r.valid_to AS rule_to
FROM u LEFT JOIN r ON u.page_id IS NOT DISTINCT FROM r.page_id AND u.url = r.url AND u.fetch_date = r.fetch_date
"""
