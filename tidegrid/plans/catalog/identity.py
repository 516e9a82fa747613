"""Series ids, labels, times, small value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions import ids, times, values
from tidegrid.operators import fetch as op
from tidegrid.operators.blocks import series_lengths
from tidegrid.plans.catalog.common import EVENTS, LINES, fnv
from tidegrid.plans.registry import query
from tidegrid.sources.points import (events_points, lineitem_points, points_from_map, read_table,
                                     with_series_id)
from tidegrid.sources.wire import parse_metric


@query("q05_series_id", f"""
SELECT series_key, {fnv('series_key')} AS series_id FROM (
  SELECT DISTINCT series_key FROM {EVENTS} UNION ALL SELECT DISTINCT series_key FROM {LINES})""")
def series_id(spark, sf_dir):
    keys = events_points(spark, sf_dir).select("series_key").distinct().unionByName(
        lineitem_points(spark, sf_dir).select("series_key").distinct())
    return with_series_id(keys)


@query("q06_bench_id", """
SELECT DISTINCT 'lineitem' || 'linestatus' || l_linestatus || 'returnflag' || l_returnflag
       AS bench_id, l_suppkey::VARCHAR AS suppkey FROM lineitem""")
def bench_id(spark, sf_dir):
    return op.series_of(lineitem_points(spark, sf_dir)).select(
        ids.bench_id(F.upper("name"), F.col("tags")).alias("bench_id"),
        F.col("tags")["suppkey"].alias("suppkey"))


@query("q74_unicode_ids", f"""
WITH tagged AS (SELECT doc_id, 'lang=' || lang || ',source=' || source || ',text=' || text || ','
                AS k FROM documents)
SELECT doc_id, {fnv('k')}::VARCHAR AS id FROM tagged""")
def unicode_ids(spark, sf_dir):
    """Ids over whole document texts: many bytes beyond ASCII in the hashed text."""
    docs = read_table(spark, sf_dir, "documents")
    tags = F.create_map(F.lit("text"), F.col("text"), F.lit("source"), F.col("source"),
                        F.lit("lang"), F.col("lang"))
    return docs.select("doc_id", ids.fnv32a_rows(ids.key_text(tags)).cast("string").alias("id"))


@query("q60_labels", """
WITH series AS (SELECT DISTINCT event_type, user_id FROM events)
SELECT event_type, user_id, 0::BIGINT AS pos, 'event_type' AS name, event_type AS value
FROM series
UNION ALL SELECT event_type, user_id, 1::BIGINT, 'user_id', user_id::VARCHAR FROM series""")
def labels(spark, sf_dir):
    series = op.series_of(events_points(spark, sf_dir))
    return series.select(
        F.col("tags")["event_type"].alias("event_type"),
        F.col("tags")["user_id"].cast("bigint").alias("user_id"),
        F.posexplode(ids.tags_to_labels(F.col("tags"))).alias("pos", "label")).select(
        "event_type", "user_id", F.col("pos").cast("bigint").alias("pos"), "label.name",
        "label.value")


@query("q61_labels_last_wins", """
SELECT event_id, user_id::VARCHAR AS who, event_type AS kind FROM events""")
def labels_last_wins(spark, sf_dir):
    def label(name, value):
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    events = read_table(spark, sf_dir, "events")
    tags = ids.labels_to_tags(F.array(
        label("who", F.col("event_id")), label("kind", F.col("props")),
        label("kind", F.col("event_type")), label("who", F.col("user_id"))))
    return events.withColumn("tags", tags).select(
        "event_id", F.col("tags")["who"].alias("who"), F.col("tags")["kind"].alias("kind"))


@query("q26_time_ms", """
SELECT event_id, epoch_us(ts) // 1000 AS millis,
       TIMESTAMP '1970-01-01' + to_milliseconds(epoch_us(ts) // 1000) AS back,
       TIMESTAMP '1970-01-01' + to_milliseconds(-event_id) AS early,
       -event_id AS early_millis
FROM events""")
def time_ms(spark, sf_dir):
    early = times.from_millis(-F.col("event_id"))
    return read_table(spark, sf_dir, "events").select(
        "event_id", times.to_millis(F.col("ts")).alias("millis"),
        times.from_millis(times.to_millis(F.col("ts"))).alias("back"),
        early.alias("early"), times.to_millis(early).alias("early_millis"))


@query("q62_value_arrays", """
SELECT event_id, round(value * (user_id % 5), 6) AS filled, value AS at_two,
       user_id % 5 <= 0 AS all_missing, user_id % 5 = 1 AS is_missing
FROM events""")
def value_arrays(spark, sf_dir):
    """Constant arrays, their sum, lookup, slices and the NaN tests."""
    size = (F.col("user_id") % 5).cast("int")
    filled = values.constant_values(F.col("value"), size)
    longer = values.constant_values(F.col("value"), F.lit(4))
    nans = F.when(F.col("user_id") % 5 == 1, F.lit(values.NAN)).otherwise(F.col("value"))
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        F.round(F.aggregate(filled, F.lit(0.0), lambda total, v: total + v), 6).alias("filled"),
        values.value_at(values.slice_values(longer, 1, 4), 2).alias("at_two"),
        values.all_missing(filled).alias("all_missing"),
        values.is_missing(nans).alias("is_missing"))


@query("q68_any_empty", """
SELECT doc_id, (text = '' OR lang = '' OR CASE WHEN n_chars > 100 THEN source ELSE '' END = '')
       AS any_empty FROM documents""")
def any_empty(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", ids.any_empty(F.col("text"), F.col("lang"),
                                F.when(F.col("n_chars") > 100, F.col("source"))
                                .otherwise(F.lit(""))).alias("any_empty"))


@query("q69_json_metrics", f"""
SELECT series_key, count(*) AS n_points, round(sum(value), 6) AS value_sum FROM {EVENTS}
GROUP BY series_key""")
def json_metrics(spark, sf_dir):
    """Each event as a JSON metric text, parsed back."""
    events = read_table(spark, sf_dir, "events")
    text = F.to_json(F.struct(
        F.lit("Events").alias("metric"), times.to_millis(F.col("ts")).alias("timestamp"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string"),
                     F.lit("event_type"), F.col("event_type")).alias("tags"), "value"))
    parsed = events.select(text.alias("text")).select(parse_metric(F.col("text")).alias("m"))
    points = points_from_map(parsed.select(
        F.col("m.metric").alias("name"), "m.tags",
        times.from_millis(F.col("m.timestamp")).alias("ts"), "m.value"))
    return points.groupBy("series_key").agg(
        F.count(F.lit(1)).alias("n_points"), F.round(F.sum("value"), 6).alias("value_sum"))


@query("q51_series_lengths", f"""
SELECT series_key, count(*) AS n_points FROM {LINES} GROUP BY series_key""")
def lengths(spark, sf_dir):
    return series_lengths(lineitem_points(spark, sf_dir), ["series_key"])


@query("q75_series_count", f"""
SELECT 'events' AS name, count(DISTINCT series_key) AS n_series FROM {EVENTS}
UNION ALL SELECT 'lineitem', count(DISTINCT series_key) FROM {LINES}""")
def series_count(spark, sf_dir):
    def one(points):
        return points.select("name", "series_key").distinct() \
            .groupBy("name").agg(F.count(F.lit(1)).alias("n_series"))
    return one(events_points(spark, sf_dir)).unionByName(one(lineitem_points(spark, sf_dir)))
