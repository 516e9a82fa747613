"""Several stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.matchers import neq
from tidegrid.operators.fetch import in_range
from tidegrid.plans.catalog.common import END, EVENTS, LINES, START, between
from tidegrid.plans.registry import query
from tidegrid.session import scratch_path
from tidegrid.sinks.points import fanout_write, read_points
from tidegrid.sources import stores as op
from tidegrid.sources.points import events_points, lineitem_points, read_table
from tidegrid.sources.wire import series_to_wire
from tidegrid.operators.grid import dense_grid, series_values


def two_stores(spark, sf_dir):
    return [op.Store("near", op.StoreType.LOCAL, events_points(spark, sf_dir, keep=[])),
            op.Store("far", op.StoreType.REMOTE, lineitem_points(spark, sf_dir, keep=[]),
                     lossy=True)]


_QUERY = op.Query((neq("event_type", "view"), neq("returnflag", "N")), "1990-01-01",
                  "2024-01-20")


@query("q21_fanout_union", f"""
SELECT 'near' AS store, 'local' AS store_type, series_key, ts, value FROM {EVENTS}
WHERE event_type <> 'view' AND ts < TIMESTAMP '2024-01-20'
UNION ALL
SELECT 'far', 'remote', series_key, ts, value::FLOAT::DOUBLE FROM {LINES}
WHERE l_returnflag <> 'N'""")
def fanout_union(spark, sf_dir):
    return op.fanout_fetch(two_stores(spark, sf_dir), _QUERY, op.allow_all) \
        .select("store", "store_type", "series_key", "ts", "value")


@query("q22_store_filter", f"""
WITH near AS (SELECT count(*) AS n FROM {EVENTS}
              WHERE event_type <> 'view' AND ts < TIMESTAMP '2024-01-20'),
     far AS (SELECT count(*) AS n FROM {LINES} WHERE l_returnflag <> 'N')
SELECT 'local_only' AS filter, n AS n_local, 0::BIGINT AS n_remote, true AS local_only FROM near
UNION ALL SELECT 'allow_all', near.n, far.n, false FROM near, far
UNION ALL SELECT 'allow_none', 0, 0, true FROM near""")
def store_filter(spark, sf_dir):
    """What each filter lets through, and whether the answer is local only."""
    parts = []
    for accept in (op.local_only, op.allow_all, op.allow_none):
        found = op.fanout_fetch(two_stores(spark, sf_dir), _QUERY, accept)
        parts.append(found.agg(
            F.lit(accept.__name__).alias("filter"),
            F.count_if(F.col("store_type") == "local").alias("n_local"),
            F.count_if(F.col("store_type") == "remote").alias("n_remote"),
            op.all_local().alias("local_only")))
    return op.append_pages(parts)


@query("q52_fanout_search", f"""
SELECT 'near' AS store, series_key FROM (SELECT DISTINCT series_key FROM {EVENTS}
  WHERE event_type <> 'view' AND {between('1999-01-01', '2024-01-03')})
UNION ALL
SELECT 'near again', series_key FROM (SELECT DISTINCT series_key FROM {EVENTS}
  WHERE event_type <> 'view' AND {between('1999-01-01', '2024-01-03')})
UNION ALL
SELECT 'far', series_key FROM (SELECT DISTINCT series_key FROM {LINES}
  WHERE l_returnflag <> 'N' AND {between('1999-01-01', '2024-01-03')})""")
def fanout_search(spark, sf_dir):
    near, far = two_stores(spark, sf_dir)
    again = op.Store("near again", op.StoreType.LOCAL, near.points)
    question = op.Query(_QUERY.matchers, "1999-01-01", "2024-01-03")
    return op.fanout_search([near, again, far], question, op.allow_all) \
        .select("store", "series_key")


@query("q23_wire_precision", """
SELECT event_id, value::FLOAT::DOUBLE AS wire_value FROM events""")
def wire_precision(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select(
        "event_id", op.wire_precision(F.col("value")).alias("wire_value"))


@query("q90_remote_pages", f"""
SELECT series_key, ts, value FROM {EVENTS} WHERE {between('2024-01-01', '2024-01-10')}
UNION ALL SELECT series_key, ts, value FROM {EVENTS} WHERE {between('2024-01-08', '2024-01-31')}
""")
def remote_pages(spark, sf_dir):
    """Pages appended as they come; what two pages share is there twice."""
    points = events_points(spark, sf_dir)
    pages = [in_range(points, "2024-01-01", "2024-01-10"),
             in_range(points, "2024-01-08", "2024-01-31")]
    return op.append_pages(pages).select("series_key", "ts", "value")


@query("q91_link_round_trip", f"""
WITH cells AS (SELECT series_key, time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS ts,
                      arg_max(value, (ts, value)) AS value
               FROM {EVENTS} WHERE {between()} GROUP BY ALL),
     grid AS (SELECT series_key, day AS ts FROM (SELECT DISTINCT series_key FROM cells)
              CROSS JOIN (SELECT TIMESTAMP '{START}' + to_days(i::INTEGER) AS day
                          FROM range(0, 20) t(i)))
SELECT series_key, ts, value IS NULL AS missing, coalesce(value::FLOAT::DOUBLE, -1) AS value
FROM grid LEFT JOIN cells USING (series_key, ts)""")
def link_round_trip(spark, sf_dir):
    """Series as arrays in 32-bit records, written, read and spread out again."""
    points = events_points(spark, sf_dir)
    by = ["name", "series_key", "tags"]
    arrays = series_values(dense_grid(points, START, END, "24h", by=by), "24h", 7, by=by)
    path = scratch_path(spark, "link")
    series_to_wire(arrays, "1m:48h").write.parquet(path)
    back = op.remote_points(spark, path)
    return back.select("series_key", "ts", F.isnan("value").alias("missing"),
                       F.when(F.isnan("value"), F.lit(-1.0)).otherwise(F.col("value"))
                       .alias("value"))


@query("q54_fanout_write", f"""
SELECT store, series_key, ts, value FROM {EVENTS}
CROSS JOIN (VALUES ('first'), ('second')) s(store)""")
def fanout_write_query(spark, sf_dir):
    """The same points written to two stores and read back; a third is filtered out."""
    root = scratch_path(spark, "fanout")
    targets = [op.Store("first", op.StoreType.LOCAL, path=f"{root}/first"),
               op.Store("away", op.StoreType.REMOTE, path=f"{root}/away"),
               op.Store("second", op.StoreType.LOCAL, path=f"{root}/second")]
    written = fanout_write(events_points(spark, sf_dir), targets, op.local_only)
    parts = [read_points(spark, f"{root}/{label}").select(
        F.lit(label).alias("store"), "series_key", "ts", "value") for label in written]
    return op.append_pages(parts)


