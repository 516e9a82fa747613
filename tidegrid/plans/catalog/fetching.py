"""Fetch, search, selectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.matchers import eq, neq, re_match, re_not
from tidegrid.operators import fetch as op
from tidegrid.plans.catalog.common import (END, EVENT_KEY, EVENTS, FIRST, LAST, SAMPLE_COLUMNS,
                                           START, between, bucket, fnv)
from tidegrid.plans.registry import query
from tidegrid.sources.points import events_points, lineitem_points, read_table, with_series_id

_FETCH = f"SELECT event_id, series_key, ts, value FROM {EVENTS} WHERE {between()} AND "


@query("q01_fetch_eq", _FETCH + "event_type = 'click'")
def fetch_eq(spark, sf_dir):
    return op.fetch(events_points(spark, sf_dir), [eq("event_type", "click")], START, END) \
        .select(*SAMPLE_COLUMNS)


@query("q02_fetch_neq", _FETCH + "event_type <> 'click' AND user_id <> 3")
def fetch_neq(spark, sf_dir):
    return op.fetch(events_points(spark, sf_dir),
                    [neq("event_type", "click"), neq("user_id", "3"), neq("absent", "x")],
                    START, END).select(*SAMPLE_COLUMNS)


@query("q03_fetch_re", _FETCH + r"regexp_full_match(event_type, 'click|purchase') AND "
                                r"regexp_full_match(user_id::VARCHAR, '[1-7]\d*')")
def fetch_re(spark, sf_dir):
    return op.fetch(events_points(spark, sf_dir),
                    [re_match("event_type", "click|purchase"), re_match("user_id", r"[1-7]\d*")],
                    START, END).select(*SAMPLE_COLUMNS)


@query("q04_fetch_nre", _FETCH + "NOT regexp_full_match(event_type, '.*i.*') AND "
                                 "NOT regexp_full_match(user_id::VARCHAR, '1.*')")
def fetch_nre(spark, sf_dir):
    return op.fetch(events_points(spark, sf_dir),
                    [re_not("event_type", ".*i.*"), re_not("user_id", "1.*")],
                    START, END).select(*SAMPLE_COLUMNS)


@query("q07_search_limit", f"""
SELECT 'default' AS namespace, {fnv('series_key')}::VARCHAR AS id,
       event_type, user_id::VARCHAR AS user_id
FROM (SELECT DISTINCT series_key, event_type, user_id FROM {EVENTS}
      WHERE event_type <> 'view' ORDER BY series_key LIMIT 500)""")
def search_limit(spark, sf_dir):
    found = op.search(events_points(spark, sf_dir), [neq("event_type", "view")])
    return op.metrics(op.limit_series(found, op.parse_limit("500"))).select(
        "namespace", "id", F.col("tags")["event_type"].alias("event_type"),
        F.col("tags")["user_id"].alias("user_id"))


@query("q47_fetch_limit", f"""
WITH kept AS (SELECT * FROM {EVENTS} WHERE {between()}),
     chosen AS (SELECT DISTINCT series_key FROM kept WHERE event_type = 'error'
                ORDER BY series_key LIMIT 100)
SELECT event_id, series_key, ts, value FROM kept SEMI JOIN chosen USING (series_key)""")
def fetch_limit(spark, sf_dir):
    return op.fetch(events_points(spark, sf_dir), [eq("event_type", "error")], START, END,
                    limit=100).select(*SAMPLE_COLUMNS)


@query("q71_fetch_by_series_table", _FETCH + "event_type IN ('error', 'view')")
def fetch_by_series_table(spark, sf_dir):
    points = events_points(spark, sf_dir)
    return op.fetch(points, [re_match("event_type", "error|view")], START, END,
                    series=op.series_of(points)).select(*SAMPLE_COLUMNS)


@query("q11_fetch_ids", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS}
WHERE {between()} AND series_key IN (
  SELECT 'event_type=purchase,user_id=' || c_custkey || ',' FROM customer
  WHERE c_mktsegment = 'BUILDING')""")
def fetch_ids(spark, sf_dir):
    ids = read_table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("event_type=purchase,user_id="), F.col("c_custkey"), F.lit(","))
        .alias("series_key"))
    return op.fetch_ids(events_points(spark, sf_dir), ids, START, END).select(*SAMPLE_COLUMNS)


@query("q12_resolve", f"""
SELECT {fnv("'event_type=click,user_id=3,'")}::VARCHAR AS id, '1m:48h' AS policy,
       event_id, series_key, ts, value
FROM {EVENTS} WHERE {between()} AND event_type = 'click' AND user_id = 3""")
def resolve(spark, sf_dir):
    request = op.resolve([eq("user_id", "3"), eq("event_type", "click")], START, END, "1m:48h")
    return request.fetch(events_points(spark, sf_dir)).select(
        request.id().alias("id"), F.lit(request.policy).alias("policy"), *SAMPLE_COLUMNS)


@query("q70_fetch_ranges", f"""
SELECT event_id, series_key, ts, value, 'short' AS policy FROM {EVENTS}
WHERE {between('2024-01-05', '2024-01-15')}
UNION ALL
SELECT event_id, series_key, ts, value, 'long' AS policy FROM {EVENTS}
WHERE {between('2024-01-10', '2024-01-25')} AND event_type = 'click'""")
def fetch_ranges(spark, sf_dir):
    points = events_points(spark, sf_dir)
    series = op.series_of(points)
    short = series.select("series_key", op.moment("2024-01-05").alias("range_start"),
                          op.moment("2024-01-15").alias("range_end"),
                          F.lit("short").alias("policy"))
    long = series.where(F.col("tags")["event_type"] == "click").select(
        "series_key", op.moment("2024-01-10").alias("range_start"),
        op.moment("2024-01-25").alias("range_end"), F.lit("long").alias("policy"))
    return op.fetch_requests(points, short.unionByName(long)).select(*SAMPLE_COLUMNS, "policy")


@query("q72_range_equality", f"""
SELECT {fnv('series_key')}::VARCHAR AS id, min(ts) AS range_start, max(ts) AS range_end,
       '1m:48h' AS policy
FROM {EVENTS} GROUP BY series_key
HAVING max(ts) = max(CASE WHEN {between('2024-01-02', '2024-01-29')} THEN ts END)
   AND min(ts) = min(CASE WHEN {between('2024-01-02', '2024-01-29')} THEN ts END)""")
def range_equality(spark, sf_dir):
    def ranges(points):
        spans = points.groupBy("series_key").agg(F.min("ts").alias("range_start"),
                                                 F.max("ts").alias("range_end"))
        return with_series_id(spans).select(F.col("series_id").cast("string").alias("id"), "series_key",
                                            "range_start", "range_end",
                                            F.lit("1m:48h").alias("policy"))
    points = events_points(spark, sf_dir)
    return op.same_ranges(ranges(points), ranges(
        op.in_range(points, "2024-01-02", "2024-01-29"))).drop("series_key")


@query("q34_offset", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS}
WHERE {between('2024-01-10', '2024-01-20')} AND event_type = 'purchase'""")
def offset(spark, sf_dir):
    selector = op.Selector("events", (eq("event_type", "purchase"),), range="240h",
                           offset="480h")
    return selector.apply(events_points(spark, sf_dir), "2024-01-30").select(*SAMPLE_COLUMNS)


@query("q49_lookback", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS}
WHERE {between('2024-01-10', '2024-01-20')} AND event_type <> 'purchase'""")
def lookback(spark, sf_dir):
    selector = op.Selector("events", (neq("event_type", "purchase"),), range="240h",
                           offset="120h", direction="lookback")
    return selector.apply(events_points(spark, sf_dir), "2024-01-25").select(*SAMPLE_COLUMNS)


@query("q50_instant", """
SELECT l_orderkey, l_linenumber, l_shipdate AS ts, l_quantity AS value FROM lineitem
WHERE l_shipdate = TIMESTAMP '1998-06-15' AND l_returnflag = 'N'""")
def instant(spark, sf_dir):
    selector = op.Selector("lineitem", (eq("returnflag", "N"),), offset="24h")
    return selector.apply(lineitem_points(spark, sf_dir), "1998-06-16") \
        .select("l_orderkey", "l_linenumber", "ts", "value")


@query("q58_read_request", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS}
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00.250' AND ts < TIMESTAMP '2024-01-25 12:00:00.750'
  AND event_type <> 'view' AND user_id <> 7
  AND regexp_full_match(event_type, '[a-p].*')
  AND NOT regexp_full_match(user_id::VARCHAR, '[0-9]')""")
def read_request(spark, sf_dir):
    matchers = [(1, "event_type", "view"), (1, "user_id", "7"), (2, "event_type", "[a-p].*"),
                (3, "user_id", "[0-9]")]
    return op.fetch_read_request(events_points(spark, sf_dir), matchers,
                                 1704412800250, 1706184000750).select(*SAMPLE_COLUMNS)


@query("q73_fetch_many", f"""
SELECT 'clicks' AS query, event_id, value FROM {EVENTS}
WHERE {between('2024-01-01', '2024-01-20')} AND event_type = 'click'
UNION ALL SELECT 'users', event_id, value FROM {EVENTS}
WHERE {between('2024-01-10', '2024-01-31')} AND regexp_full_match(user_id::VARCHAR, '1[0-9]*')
UNION ALL SELECT 'all', event_id, value FROM {EVENTS} WHERE {between(FIRST, LAST)}""")
def fetch_many(spark, sf_dir):
    return op.fetch_many(events_points(spark, sf_dir), [
        ("clicks", [eq("event_type", "click")], "2024-01-01", "2024-01-20"),
        ("users", [re_match("user_id", "1[0-9]*")], "2024-01-10", "2024-01-31"),
        ("all", [], FIRST, LAST)]).select("query", "event_id", "value")


@query("q46_flagship", f"""
SELECT event_type, step_ts, round(sum(value), 6) AS step_sum FROM (
  SELECT event_type, {EVENT_KEY} AS k, {bucket('1 hour')} AS step_ts, sum(value) AS value
  FROM events
  WHERE regexp_full_match(event_type, 'click|purchase') AND user_id <> 3
    AND {between('2024-01-05', '2024-01-15')}
  GROUP BY ALL) GROUP BY ALL""")
def flagship(spark, sf_dir):
    """Matchers, ten days, consolidation to an hour, sum across series by event type."""
    from tidegrid.operators.aggregate import step_sum
    from tidegrid.operators.grid import consolidate
    points = op.fetch(events_points(spark, sf_dir),
                      [re_match("event_type", "click|purchase"), neq("user_id", "3")],
                      "2024-01-05", "2024-01-15")
    tagged = points.withColumn("event_type", F.col("tags")["event_type"])
    hourly = consolidate(tagged, {"default": "1h"}, "sum", by=["series_key", "event_type"])
    return step_sum(hourly, by=["event_type"]) \
        .withColumn("step_sum", F.round("step_sum", 6))
