"""Regridding, dense grids, consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.times import tumbling
from tidegrid.functions.values import NAN
from tidegrid.operators import grid as op
from tidegrid.operators.aggregate import at_steps
from tidegrid.plans.catalog.common import EVENTS, FIRST, LAST, LINES, START, between, bucket
from tidegrid.plans.registry import query
from tidegrid.sources.points import events_points, lineitem_points


@query("q08_regrid", f"""
SELECT event_id, series_key, step_idx,
       TIMESTAMP '2024-01-05' + to_minutes(step_idx::INTEGER) AS step_ts, value
FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts, event_id) - 1 AS step_idx
      FROM {EVENTS})""")
def regrid(spark, sf_dir):
    return op.regrid(events_points(spark, sf_dir), START, "1m", tie=["event_id"]) \
        .select("event_id", "series_key", "step_idx", "step_ts", "value")


def _positional_sql(order: str, start: str, step_seconds: int, source: str, columns: str) -> str:
    return f"""
SELECT {columns}, series_key, step_idx,
       TIMESTAMP '{start}' + to_seconds(step_idx * {step_seconds}) AS step_ts, value
FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY {order}) - 1 AS step_idx
      FROM {source})"""


_LINE_ORDER = ["l_orderkey", "l_linenumber", "value", "l_partkey"]
_LINE_SQL = _positional_sql("ts, " + ", ".join(_LINE_ORDER), "1995-01-01", 10, LINES,
                            "l_orderkey, l_linenumber")


def _lines_regridded(spark, sf_dir, **plan):
    points = lineitem_points(spark, sf_dir, keep=["l_orderkey", "l_linenumber", "l_partkey"])
    return op.regrid(points, "1995-01-01", "10s", tie=_LINE_ORDER, block="720h", **plan) \
        .select("l_orderkey", "l_linenumber", "series_key", "step_idx", "step_ts", "value")


@query("q76_regrid_lineitem", _LINE_SQL)
def regrid_lineitem(spark, sf_dir):
    return _lines_regridded(spark, sf_dir)


@query("q107_regrid_no_tie", f"""
SELECT l_orderkey, l_linenumber, series_key, value, step_idx
FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts, value, l_orderkey,
             l_linenumber, l_partkey) - 1 AS step_idx FROM {LINES})""")
def regrid_no_tie(spark, sf_dir):
    """No tie given: samples of one day follow by all that they hold."""
    points = lineitem_points(spark, sf_dir, keep=["l_orderkey", "l_linenumber", "l_partkey"])
    return op.regrid(points, "1995-01-01", "10s", block="720h").select(
        "l_orderkey", "l_linenumber", "series_key", "value", "step_idx")


@query("q108_null_times", f"""
SELECT step_ts, count(*) AS n, count(DISTINCT series_key) AS n_series
FROM (SELECT series_key, {bucket('1 hour', 't0')} AS step_ts
      FROM (SELECT *, CASE WHEN event_id % 7 <> 0 THEN ts END AS t0 FROM {EVENTS}))
GROUP BY ALL""")
def null_times(spark, sf_dir):
    """A sample without a time is in a step of its own, the one of no time: none is lost."""
    points = events_points(spark, sf_dir).withColumn(
        "ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    return at_steps(points, "1h").groupBy("step_ts").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("series_key").alias("n_series"))


@query("q103_regrid_cut", _positional_sql("ts, event_id", FIRST, 60, EVENTS, "event_id"))
def regrid_cut(spark, sf_dir):
    """Numbered in short blocks: the same positions as in long ones."""
    return op.regrid(events_points(spark, sf_dir), FIRST, "1m", tie=["event_id"], block="1h") \
        .select("event_id", "series_key", "step_idx", "step_ts", "value")


@query("q104_regrid_sliced", _LINE_SQL)
def regrid_sliced(spark, sf_dir):
    """The plan for series that are long even inside one block: balanced slices."""
    return _lines_regridded(spark, sf_dir, slices=16)


# the events at ten minutes, and their hourly sums as a second namespace
_TWO_NAMESPACES = f"""(
  SELECT '10m' AS namespace, series_key, ts, value FROM {EVENTS}
  UNION ALL
  SELECT '1h', series_key, {bucket('1 hour')} AS ts, sum(value) FROM {EVENTS} GROUP BY ALL)"""
_RESOLUTIONS = {"10m": "10m", "1h": "1h"}


def two_namespaces(spark, sf_dir):
    fine = events_points(spark, sf_dir, namespace="10m", keep=[])
    hourly = fine.groupBy("name", "series_key", "tags", tumbling(F.col("ts"), "1h").start
                          .alias("ts")).agg(F.sum("value").alias("value"))
    return fine.unionByName(hourly.withColumn("namespace", F.lit("1h")))


def _register_fold(fn: str, inner: str, outer: str) -> None:
    @query(f"q13_consolidate_{fn}", f"""
SELECT series_key, step_ts, round({outer}, 6) AS value FROM (
  SELECT namespace, series_key, {bucket('1 hour')} AS step_ts, max(ts) AS ts, {inner} AS value
  FROM {_TWO_NAMESPACES} GROUP BY namespace, series_key, {bucket('1 hour')})
GROUP BY series_key, step_ts""")
    def consolidate(spark, sf_dir):
        return op.consolidate(two_namespaces(spark, sf_dir), _RESOLUTIONS, fn).select(
            "series_key", "step_ts", F.round("value", 6).alias("value"))


for _fn, _sql in {"sum": "sum(value)", "avg": "avg(value)", "min": "min(value)",
                  "max": "max(value)", "count": "count(value)::DOUBLE",
                  "last": "arg_max(value, (ts, value))"}.items():
    _register_fold(_fn, _sql, _sql)


@query("q120_consolidate_flat", f"""
SELECT series_key, {bucket('1 hour')} AS step_ts, count(*)::DOUBLE AS value
FROM {_TWO_NAMESPACES} GROUP BY ALL""")
def consolidate_flat(spark, sf_dir):
    """The samples of all namespaces as one lot."""
    return op.consolidate(two_namespaces(spark, sf_dir), _RESOLUTIONS, "count", flat=True) \
        .select("series_key", "step_ts", "value")


@query("q121_last_lineitem", f"""
SELECT series_key, {bucket('168 hours')} AS step_ts, arg_max(value, (ts, value)) AS value
FROM (SELECT series_key, ts::TIMESTAMP AS ts, value::DOUBLE AS value FROM {LINES}) GROUP BY ALL""")
def last_lineitem(spark, sf_dir):
    """The last sample of a week, where many samples have the same day."""
    return op.consolidate(lineitem_points(spark, sf_dir), {"default": "168h"}, "last") \
        .select("series_key", "step_ts", "value")


@query("q77_custom_fold", f"""
SELECT series_key, step_ts, round(sum(CASE WHEN namespace = '10m' THEN 0.5 ELSE 1.0 END * m), 6)
       AS value
FROM (SELECT namespace, series_key, {bucket('1 hour')} AS step_ts, max(value) AS m
      FROM {_TWO_NAMESPACES} GROUP BY ALL) GROUP BY ALL""")
def custom_fold(spark, sf_dir):
    """A fold of the caller: the first namespace counts half, later ones in full."""
    def merge(existing, to_add, count):
        return existing + F.when(count == 0, to_add * 0.5).otherwise(to_add)
    return op.consolidate_custom(two_namespaces(spark, sf_dir), _RESOLUTIONS, "max", 0.0, merge) \
        .select("series_key", "step_ts", F.round("value", 6).alias("value"))


_GRID = f"""
WITH cells AS (SELECT series_key, {bucket('1 day')} AS step_ts, arg_max(value, (ts, value)) AS value
               FROM {EVENTS} WHERE {between(FIRST, LAST)} GROUP BY ALL),
     days AS (SELECT i AS step_idx, TIMESTAMP '2024-01-01' + to_days(i::INTEGER) AS step_ts
              FROM range(0, 30) t(i)),
     grid AS (SELECT series_key, step_idx, step_ts, coalesce(value, 'NaN'::DOUBLE) AS value
              FROM (SELECT DISTINCT series_key FROM cells) CROSS JOIN days
              LEFT JOIN cells USING (series_key, step_ts))
"""


def daily_grid(spark, sf_dir):
    return op.dense_grid(events_points(spark, sf_dir), FIRST, LAST, "24h")


@query("q14_dense_grid", _GRID + """
SELECT series_key, step_idx, step_ts, isnan(value) AS missing,
       CASE WHEN isnan(value) THEN -1 ELSE value END AS value FROM grid""")
def dense_grid(spark, sf_dir):
    return daily_grid(spark, sf_dir).select(
        "series_key", "step_idx", "step_ts", F.isnan("value").alias("missing"),
        F.when(F.isnan("value"), F.lit(-1.0)).otherwise(F.col("value")).alias("value"))


@query("q15_all_nan", _GRID + """
SELECT series_key, bool_and(isnan(value)) AS all_nan FROM grid
WHERE step_idx < 7 GROUP BY series_key""")
def all_nan(spark, sf_dir):
    return op.missing_series(op.slice_steps(daily_grid(spark, sf_dir), 0, 7), ["series_key"])


@query("q78_all_nan_total", """
SELECT bool_and(isnan(value)) AS all_nan,
       coalesce(bool_and(isnan(value)) FILTER (value > 0), true) AS all_nan_positive,
       bool_and(isnan(CASE WHEN value >= 0 THEN 'NaN'::DOUBLE ELSE value END)) AS all_nan_masked,
       coalesce(bool_and(isnan(value)) FILTER (value < 0), true) AS all_nan_empty
FROM events""")
def all_nan_total(spark, sf_dir):
    points = events_points(spark, sf_dir)
    masked = points.withColumn("value", F.when(F.col("value") >= 0, F.lit(NAN))
                               .otherwise(F.col("value")))
    parts = [op.all_missing(points), op.all_missing(points.where("value > 0")),
             op.all_missing(masked), op.all_missing(points.where("value < 0"))]
    flags = [p.withColumn("at", F.lit(i)) for i, p in enumerate(parts)]
    both = flags[0].unionByName(flags[1]).unionByName(flags[2]).unionByName(flags[3])
    names = ["all_nan", "all_nan_positive", "all_nan_masked", "all_nan_empty"]
    return both.agg(*[F.bool_or(F.when(F.col("at") == i, F.col("all_nan"))).alias(n)
                      for i, n in enumerate(names)])


@query("q16_slice", _GRID + """
SELECT series_key, step_idx, step_ts, isnan(value) AS missing FROM grid
WHERE step_idx >= 5 AND step_idx < 12""")
def slice_steps(spark, sf_dir):
    return op.slice_steps(daily_grid(spark, sf_dir), 5, 12).select(
        "series_key", "step_idx", "step_ts", F.isnan("value").alias("missing"))


@query("q63_value_at", _GRID + """
SELECT series_key, isnan(value) AS missing, coalesce(nullif(value, 'NaN'::DOUBLE), -1) AS value
FROM grid WHERE step_idx = 10""")
def value_at(spark, sf_dir):
    return op.value_at_step(daily_grid(spark, sf_dir), 10).select(
        "series_key", F.isnan("value").alias("missing"),
        F.when(F.isnan("value"), F.lit(-1.0)).otherwise(F.col("value")).alias("value"))


@query("q79_series_values", _GRID + """
SELECT series_key, step_idx // 12 AS part, min(step_ts) AS start_time, 86400000 AS millis_per_step,
       count(*) AS n_values, count(*) FILTER (isnan(value)) AS n_missing,
       round(coalesce(sum(value) FILTER (NOT isnan(value)), 0), 6) AS value_sum
FROM grid GROUP BY ALL""")
def series_values(spark, sf_dir):
    """Value arrays of the grid, in parts of twelve steps."""
    arrays = op.series_values(daily_grid(spark, sf_dir), "24h", max_steps=12)
    real = F.filter("values", lambda v: ~F.isnan(v))
    return arrays.select(
        "series_key", "part", "start_time", "millis_per_step",
        F.size("values").cast("bigint").alias("n_values"),
        (F.size("values") - F.size(real)).cast("bigint").alias("n_missing"),
        F.round(F.aggregate(real, F.lit(0.0), lambda a, v: a + v), 6).alias("value_sum"))
