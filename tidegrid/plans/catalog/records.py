"""Nested records, JSON, batches, point writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.matchers import eq
from tidegrid.functions.times import to_millis, tumbling
from tidegrid.operators.fetch import fetch, metrics, search
from tidegrid.operators.grid import regrid
from tidegrid.plans.catalog.common import END, EVENTS, FIRST, LINES, START, between, fnv
from tidegrid.plans.registry import query
from tidegrid.session import scratch_path
from tidegrid.sinks import points as point_sink
from tidegrid.sinks import records as op
from tidegrid.sources import wire
from tidegrid.sources.points import events_points, lineitem_points, read_table


def write_requests(spark, sf_dir):
    """Events as write requests: of each series and day, rows of at most 1,000 samples."""
    sample = F.struct("value", to_millis(F.col("ts")).alias("timestamp"))
    events = read_table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", "ts", "value") \
        .withColumn("day", tumbling(F.col("ts"), "24h").start)
    daily = op.bounded_parts(events, ["event_type", "user_id", "day"], ["event_id"], 1000) \
        .groupBy("event_type", "user_id", "day", "part") \
        .agg(F.collect_list(sample).alias("samples"))
    labels = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                       for c in ("user_id", "event_type")])
    return daily.select(labels.alias("labels"), "samples")


@query("q24_write_explode", f"""
SELECT series_key, event_type, user_id::VARCHAR AS user_id, date_trunc('milliseconds', ts) AS ts,
       value, 2 AS unit
FROM {EVENTS}""")
def write_explode(spark, sf_dir):
    points = wire.write_request_points(write_requests(spark, sf_dir))
    return points.select("series_key", F.col("tags")["event_type"].alias("event_type"),
                         F.col("tags")["user_id"].alias("user_id"), "ts", "value", "unit")


def _nested_sql(source: str, order: str, start: str, step_ms: int, size: int) -> str:
    return f"""
SELECT series_key, step_idx // {size} AS part, step_idx % {size} AS pos, value,
       epoch_ms(TIMESTAMP '{start}') + step_idx * {step_ms} AS timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY {order}) - 1 AS step_idx
      FROM {source})"""


def _flat(nested):
    return nested.select("series_key", "part", F.posexplode("samples").alias("pos", "s")).select(
        "series_key", "part", F.col("pos").cast("bigint").alias("pos"), "s.value", "s.timestamp")


@query("q25_result_nest", _nested_sql(EVENTS, "ts, event_id", FIRST, 60000, 50))
def result_nest(spark, sf_dir):
    return _flat(op.nest_result(events_points(spark, sf_dir), FIRST, "1m", tie=["event_id"],
                                part_samples=50))


@query("q92_result_labels", f"""
SELECT series_key, (row_number() OVER (PARTITION BY series_key ORDER BY p) - 1)::BIGINT AS part,
       'event_type' || '=' || event_type || ';' || 'user_id' || '=' || user_id AS labels
FROM (SELECT series_key, event_type, user_id, step_idx // 50 AS p FROM (
        SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts) - 1 AS step_idx
        FROM {EVENTS}) GROUP BY ALL)""")
def result_labels(spark, sf_dir):
    nested = op.nest_result(events_points(spark, sf_dir), FIRST, "1m", part_samples=50)
    text = F.transform("labels", lambda l: F.concat(l["name"], F.lit("="), l["value"]))
    return nested.select("series_key", "part", F.array_join(text, ";").alias("labels"))


@query("q45_batches", f"""
SELECT place // 500 AS batch_id, place % 500 AS pos, 1 AS n_samples, value, timestamp,
       'event_type=' || event_type || ';user_id=' || user_id AS labels
FROM (SELECT *, epoch_us(ts) // 1000 AS timestamp, row_number() OVER (ORDER BY ts, event_id) - 1 AS place
      FROM {EVENTS})""")
def batches(spark, sf_dir):
    made = op.time_batches(events_points(spark, sf_dir), 500, tie=["event_id"])
    flat = made.select("batch_id", F.posexplode("timeseries").alias("pos", "t"))
    text = F.transform("t.labels", lambda l: F.concat(l["name"], F.lit("="), l["value"]))
    return flat.select(
        "batch_id", F.col("pos").cast("bigint").alias("pos"),
        F.size("t.samples").alias("n_samples"), F.col("t.samples")[0]["value"].alias("value"),
        F.col("t.samples")[0]["timestamp"].alias("timestamp"),
        F.array_join(text, ";").alias("labels"))


def write_metric_lines(spark, sf_dir):
    """Events as JSON metric lines, with a blank line in front of some."""
    text = F.to_json(F.struct(
        F.initcap(F.lit("events")).alias("metric"), to_millis(F.col("ts")).alias("timestamp"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string"),
                     F.lit("event_type"), F.col("event_type")).alias("tags"), "value"))
    path = scratch_path(spark, "lines")
    read_table(spark, sf_dir, "events").select(
        F.concat(F.when(F.col("event_id") % 10 == 0, F.lit("\n  \n")).otherwise(F.lit("")), text)
        .alias("line")).write.text(path)
    return path


@query("q44_json_source", """
SELECT 'eventsevent_type' || event_type AS bench_id, date_trunc('milliseconds', ts) AS ts, value
FROM events""")
def json_source(spark, sf_dir):
    lines = wire.read_metric_lines(spark, write_metric_lines(spark, sf_dir))
    return wire.metric_ids(lines)


@query("q93_json_unique_ids", """
SELECT DISTINCT 'eventsevent_type' || event_type AS bench_id FROM events""")
def json_unique_ids(spark, sf_dir):
    lines = wire.read_metric_lines(spark, write_metric_lines(spark, sf_dir))
    return wire.metric_ids(lines).select("bench_id").distinct()


@query("q94_json_requests", f"""
SELECT series_key, date_trunc('milliseconds', ts) AS ts, value, '' AS name FROM {EVENTS}""")
def json_requests(spark, sf_dir):
    """JSON metrics as write requests; the metric name does not survive as a label."""
    lines = wire.read_metric_lines(spark, write_metric_lines(spark, sf_dir))
    return wire.write_request_points(wire.metric_requests(lines)) \
        .select("series_key", "ts", "value", "name")


@query("q95_json_points", f"""
SELECT series_key, date_trunc('milliseconds', ts) AS ts, value, 'Events' AS name FROM {EVENTS}""")
def json_points(spark, sf_dir):
    lines = wire.read_metric_lines(spark, write_metric_lines(spark, sf_dir))
    return wire.metric_points(lines).select("series_key", "ts", "value", "name")


@query("q55_search_json", f"""
SELECT '{{"namespace":"default","id":"' || {fnv('series_key')} || '","tags":{{"event_type":"'
       || event_type || '","user_id":"' || user_id || '"}}}}' AS json
FROM (SELECT DISTINCT series_key, event_type, user_id FROM {EVENTS})""")
def search_json(spark, sf_dir):
    return op.search_json(metrics(search(events_points(spark, sf_dir))))


@query("q96_search_json_files", f"""
SELECT {fnv('series_key')}::VARCHAR AS id, event_type, user_id::VARCHAR AS user_id
FROM (SELECT DISTINCT series_key, event_type, user_id FROM {EVENTS} WHERE event_type = 'signup')""")
def search_json_files(spark, sf_dir):
    path = scratch_path(spark, "search")
    op.write_search_json(metrics(search(events_points(spark, sf_dir),
                                        [eq("event_type", "signup")])), path)
    back = spark.read.schema("namespace string, id string, tags map<string, string>").json(path)
    return back.select("id", F.col("tags")["event_type"].alias("event_type"),
                       F.col("tags")["user_id"].alias("user_id"))


@query("q97_result_json", f"""
SELECT series_key, count(*) AS n_samples, round(sum(value), 6) AS value_sum FROM {LINES}
GROUP BY ALL""")
def result_json(spark, sf_dir):
    """A read result as JSON text, parsed back."""
    points = lineitem_points(spark, sf_dir)
    grid = regrid(points, "1995-01-01", "1m", tie=["l_orderkey", "l_linenumber"], block="720h")
    texts = op.result_json(op.nest_series(grid, part_samples=200))
    back = texts.select(F.from_json("json", wire.WRITE_REQUEST).alias("r")).select("r.*")
    return wire.write_request_points(back).groupBy("series_key").agg(
        F.count(F.lit(1)).alias("n_samples"), F.round(F.sum("value"), 6).alias("value_sum"))


@query("q53_point_write", f"""
SELECT event_id, series_key, ts, value, user_id::VARCHAR AS user_id FROM {EVENTS}
WHERE {between()} AND event_type = 'click'""")
def point_write(spark, sf_dir):
    """All points written with one tag promoted; the fetch prunes dates and filters on it."""
    path = scratch_path(spark, "points")
    point_sink.write_points(events_points(spark, sf_dir), path, promote=["event_type"],
                            keep=["event_id"])
    stored = point_sink.read_points(spark, path)
    return fetch(stored, [eq("event_type", "click")], START, END).select(
        "event_id", "series_key", "ts", "value", F.col("tags")["user_id"].alias("user_id"))


@query("q98_untagged_write", f"""
WITH series AS (SELECT series_key, {fnv('series_key')}::VARCHAR AS id
                FROM (SELECT DISTINCT series_key FROM {LINES}))
SELECT id, ts, value FROM {LINES} JOIN series USING (series_key)""")
def untagged_write(spark, sf_dir):
    path = scratch_path(spark, "untagged")
    point_sink.write_untagged(lineitem_points(spark, sf_dir), path, cut="year")
    return point_sink.read_points(spark, path).select("id", "ts", "value")


@query("q99_batch_write", f"""
SELECT series_key, date_trunc('milliseconds', ts) AS ts, value FROM {EVENTS}""")
def batch_write(spark, sf_dir):
    """All write requests of a batch, spread out and stored in one job."""
    path = scratch_path(spark, "batch")
    point_sink.write_points(wire.write_request_points(write_requests(spark, sf_dir)), path)
    return point_sink.read_points(spark, path).select("series_key", "ts", "value")


@query("q100_stored_series", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS}
WHERE {between()} AND event_type IN ('view', 'error')""")
def stored_series(spark, sf_dir):
    """Points and their series table stored side by side: matching reads the series alone."""
    from tidegrid.functions.matchers import re_match
    root = scratch_path(spark, "store")
    points = events_points(spark, sf_dir)
    point_sink.write_points(points, f"{root}/points", keep=["event_id"])
    point_sink.write_series(points, f"{root}/series")
    return fetch(point_sink.read_points(spark, f"{root}/points"),
                 [re_match("event_type", "view|err.*")], START, END,
                 series=point_sink.read_points(spark, f"{root}/series")) \
        .select("event_id", "series_key", "ts", "value")


@query("q126_write_batches", f"""
SELECT series_key, date_trunc('milliseconds', ts) AS ts, value, true AS bounded FROM {EVENTS}""")
def write_batches(spark, sf_dir):
    """Write requests in files of at most 100, and all of their samples read back."""
    path = scratch_path(spark, "files")
    op.write_batches(write_requests(spark, sf_dir), path, 100)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    long = stored.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where("n > 100")
    kept = stored.join(long, "file", "left").withColumn("bounded", F.col("n").isNull())
    points = [wire.write_request_points(kept.where(F.col("bounded") == b).drop("file", "n"))
              .withColumn("bounded", F.lit(b)) for b in (True, False)]
    return points[0].unionByName(points[1]).select("series_key", "ts", "value", "bounded")
