"""Blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.matchers import eq, neq
from tidegrid.operators import blocks as op
from tidegrid.operators.aggregate import at_steps
from tidegrid.operators.fetch import fetch
from tidegrid.operators.grid import consolidate
from tidegrid.plans.catalog.common import END, EVENTS, FIRST, LAST, LINES, START, between, bucket
from tidegrid.plans.catalog.grids import two_namespaces
from tidegrid.plans.registry import query
from tidegrid.sources.points import events_points, lineitem_points


@query("q48_fetch_blocks", f"""
SELECT event_id, series_key, ts, value, {bucket('5 hours')} AS block_start,
       {bucket('5 hours')} + INTERVAL '5 hours' AS block_end
FROM {EVENTS} WHERE {between()} AND event_type <> 'error'""")
def fetch_blocks(spark, sf_dir):
    return op.fetch_blocks(events_points(spark, sf_dir), [neq("event_type", "error")],
                           START, END, "5h") \
        .select("event_id", "series_key", "ts", "value", "block_start", "block_end")


_BLOCKS = f"""
WITH blocks AS (
  SELECT *, block_start + INTERVAL '2 days' AS block_end,
         (row_number() OVER (PARTITION BY series_key ORDER BY block_start) - 1)::INTEGER
           AS block_idx
  FROM (SELECT series_key, {bucket('2 days')} AS block_start, count(*) AS n_points,
               round(sum(value), 6) AS value_sum
        FROM {EVENTS} GROUP BY ALL))
"""


def two_day_blocks(spark, sf_dir):
    return op.series_blocks(events_points(spark, sf_dir), "48h")


@query("q17_blocks", _BLOCKS + "SELECT * FROM blocks")
def blocks(spark, sf_dir):
    return two_day_blocks(spark, sf_dir).select(
        "series_key", "block_start", "block_end", "block_idx", "n_points",
        F.round("value_sum", 6).alias("value_sum"))


@query("q80_block_summary", f"""
SELECT block_start, block_start + INTERVAL '30 days' AS block_end, count(*) AS n_records,
       sum(n_points)::BIGINT AS n_points, round(sum(value_sum), 6) AS value_sum
FROM (SELECT series_key, {bucket('30 days')} AS block_start, count(*) AS n_points,
             sum(value) AS value_sum FROM {LINES} GROUP BY ALL) GROUP BY ALL""")
def block_summary(spark, sf_dir):
    monthly = op.series_blocks(lineitem_points(spark, sf_dir), "720h")
    return op.block_summary(monthly).withColumn("value_sum", F.round("value_sum", 6))


_MERGED = f"""
WITH blocks AS (
  SELECT *, (row_number() OVER (PARTITION BY namespace, series_key ORDER BY block_start) - 1)
         ::INTEGER AS block_idx
  FROM (SELECT namespace, series_key, {bucket('2 days')} AS block_start, count(*) AS n_points
        FROM (SELECT '10m' AS namespace, series_key, ts FROM {EVENTS}
              UNION ALL SELECT DISTINCT '1h', series_key, {bucket('1 hour')} FROM {EVENTS})
        GROUP BY ALL)),
     merged AS (
  SELECT series_key, block_idx, min(block_start) AS block_start, count(*) AS n_namespaces,
         sum(n_points)::BIGINT AS n_points
  FROM blocks GROUP BY ALL)
"""


@query("q18_block_transpose", _MERGED + """
SELECT block_idx, block_start, block_start + INTERVAL '2 days' AS block_end, series_key,
       n_namespaces, n_points FROM merged""")
def block_transpose(spark, sf_dir):
    """Namespaces merged per series, then series gathered under each time bound."""
    per_namespace = op.series_blocks(two_namespaces(spark, sf_dir), "48h")
    # an hour's sample is at the hour, so both namespaces have the same blocks
    rows = op.by_time(op.merge_namespaces(per_namespace), strict=False)
    return rows.select(
        "block_idx", "block_start", "block_end", "series_key",
        F.size("parts").cast("bigint").alias("n_namespaces"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + p["n_points"])
        .alias("n_points"))


@query("q19_misaligned", _BLOCKS + """
SELECT block_idx, min_start, max_start, min_end, max_end, f <> overall AS missing_in_first
FROM (SELECT *, min(f) OVER () AS overall FROM (
        SELECT block_idx, min(block_start) AS min_start, max(block_start) AS max_start,
               min(block_end) AS min_end, max(block_end) AS max_end, min(series_key) AS f
        FROM blocks GROUP BY block_idx))
WHERE min_start <> max_start OR min_end <> max_end OR f <> overall""")
def misaligned(spark, sf_dir):
    return op.misaligned_blocks(two_day_blocks(spark, sf_dir))


@query("q81_namespaces_misaligned", f"""
WITH samples AS (SELECT '10m' AS namespace, series_key, ts FROM {EVENTS}
                 UNION ALL SELECT '1h', series_key, ts FROM {EVENTS} WHERE value > 20),
     blocks AS (
  SELECT *, row_number() OVER (PARTITION BY namespace, series_key ORDER BY block_start) - 1
         AS block_idx
  FROM (SELECT DISTINCT namespace, series_key, {bucket('2 days')} AS block_start FROM samples))
SELECT series_key, block_idx::INTEGER AS block_idx, min(block_start) AS min_start,
       max(block_start) AS max_start
FROM blocks GROUP BY ALL HAVING min(block_start) <> max(block_start)""")
def namespaces_misaligned(spark, sf_dir):
    """A second namespace with gaps: its i-th block is no longer the first one's i-th."""
    fine = events_points(spark, sf_dir, namespace="10m")
    sparse = events_points(spark, sf_dir, namespace="1h").where("value > 20")
    per_namespace = op.series_blocks(fine.unionByName(sparse), "48h")
    return op.misaligned_blocks(per_namespace, by=["series_key"], member="namespace") \
        .select("series_key", "block_idx", "min_start", "max_start")


@query("q20_common_tags", f"""
WITH kept AS (SELECT DISTINCT {bucket('1 day')} AS block_start, event_type, user_id
              FROM events WHERE event_type = 'click' AND {between(FIRST, LAST)}),
     sizes AS (SELECT block_start, count(*) AS n_series FROM kept GROUP BY ALL),
     entries AS (SELECT block_start, 'event_type' AS tag, event_type AS tag_value FROM kept
                 UNION ALL SELECT block_start, 'user_id', user_id::VARCHAR FROM kept)
SELECT block_start, tag, tag_value, n_series
FROM (SELECT block_start, tag, tag_value, count(*) AS n FROM entries GROUP BY ALL)
JOIN sizes USING (block_start) WHERE n = n_series""")
def common_tags(spark, sf_dir):
    points = fetch(events_points(spark, sf_dir), [eq("event_type", "click")], FIRST, LAST)
    return op.common_tags(points, "24h")


@query("q59_steps", f"""
SELECT step_ts, count(*) AS n_values, round(sum(value), 6) AS value_sum FROM (
  SELECT series_key, {bucket('1 hour')} AS step_ts, sum(value) AS value FROM {EVENTS}
  GROUP BY ALL) GROUP BY ALL""")
def steps(spark, sf_dir):
    hourly = consolidate(events_points(spark, sf_dir), {"default": "1h"}, "sum")
    return op.steps(hourly).withColumn("value_sum", F.round("value_sum", 6))


@query("q82_block_sizes", f"""
SELECT {bucket('2 hours')} AS step_ts, count(*) AS n_values, round(sum(value), 6) AS value_sum
FROM events GROUP BY ALL""")
def block_sizes(spark, sf_dir):
    """Bucketing by a namespace's block size."""
    return op.steps(at_steps(events_points(spark, sf_dir), "2h")) \
        .withColumn("value_sum", F.round("value_sum", 6))
