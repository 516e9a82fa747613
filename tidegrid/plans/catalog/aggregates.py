"""Aggregation across series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.values import NAN
from tidegrid.operators import aggregate as op
from tidegrid.operators.fetch import fetch, matching
from tidegrid.operators.grid import consolidate
from tidegrid.operators.vector import vector
from tidegrid.plans import compose
from tidegrid.plans.catalog.common import EVENTS, FIRST, LAST, LINES, bucket
from tidegrid.plans.registry import query
from tidegrid.session import scratch_path
from tidegrid.sources.points import events_points, lineitem_points

# hourly sums of each series: the vector of a step has one value per series
HOURLY_SQL = f"""(
  SELECT series_key, event_type, user_id::VARCHAR AS user_id, {bucket('1 hour')} AS step_ts,
         round(sum(value), 6) AS value FROM {EVENTS} GROUP BY ALL)"""


EVENT_TAGS = ["event_type", "user_id"]


def hourly(spark, sf_dir, matchers=()):
    """The tags are grouped on as columns; map and key text are made of them afterwards."""
    points = matching(events_points(spark, sf_dir), matchers)
    tagged = points.select("*", *op.tag_columns(points, EVENT_TAGS))
    summed = consolidate(tagged, {"default": "1h"}, "sum", by=EVENT_TAGS)
    return vector(summed, EVENT_TAGS, name="events").withColumn("value", F.round("value", 6))


@query("q09_step_sum", f"""
SELECT step_ts, round(sum(value), 6) AS step_sum FROM {HOURLY_SQL} GROUP BY ALL""")
def step_sum(spark, sf_dir):
    points = op.at_steps(events_points(spark, sf_dir), "1h")
    return op.step_sum(points).withColumn("step_sum", F.round("step_sum", 6))


@query("q10_step_count", f"""
SELECT step_ts, count(*) AS step_count FROM {HOURLY_SQL} GROUP BY ALL""")
def step_count(spark, sf_dir):
    return op.step_count(consolidate(events_points(spark, sf_dir), {"default": "1h"}, "sum"))


@query("q83_step_sum_nan", f"""
SELECT step_ts, bool_or(user_id = 7) AS is_nan,
       round(coalesce(sum(value) FILTER (user_id <> 7), 0), 6) AS rest_sum
FROM (SELECT *, {bucket('1 hour')} AS step_ts FROM events) GROUP BY ALL""")
def step_sum_nan(spark, sf_dir):
    """A NaN sample makes the sum of its step NaN."""
    points = op.at_steps(events_points(spark, sf_dir), "1h")
    seven = F.col("tags")["user_id"] == "7"
    holed = points.withColumn("value", F.when(seven, F.lit(NAN)).otherwise(F.col("value")))
    rest = points.withColumn("value", F.when(seven, F.lit(0.0)).otherwise(F.col("value")))
    both = compose.from_parents({"holed": holed, "rest": rest}, op.step_sum)
    return both.groupBy("step_ts").agg(
        F.bool_or((F.col("parent") == "holed") & F.isnan("step_sum")).alias("is_nan"),
        F.round(F.max(F.when(F.col("parent") == "rest", F.col("step_sum"))), 6).alias("rest_sum"))


def _register_by(fn: str, sql: str, number: str) -> None:
    @query(f"{number}_agg_by_{fn}", f"""
SELECT event_type, step_ts, round({sql}, 6) AS value FROM {HOURLY_SQL} GROUP BY ALL""")
    def agg_by(spark, sf_dir):
        return op.aggregate(hourly(spark, sf_dir), fn, by=["event_type"]) \
            .withColumn("value", F.round("value", 6))

    @query(f"q28_agg_without_{fn}", f"""
SELECT 'event_type=' || event_type || ',' AS group_key, step_ts, round({sql}, 6) AS value
FROM {HOURLY_SQL} GROUP BY ALL""")
    def agg_without(spark, sf_dir):
        return op.aggregate(hourly(spark, sf_dir), fn, without=["user_id"]) \
            .withColumn("value", F.round("value", 6))


for _fn, _sql, _number in [
        ("sum", "sum(value)", "q27"), ("avg", "avg(value)", "q27"), ("min", "min(value)", "q27"),
        ("max", "max(value)", "q27"), ("count", "count(value)::DOUBLE", "q27"),
        ("stddev", "stddev_pop(value)", "q33"), ("stdvar", "var_pop(value)", "q33")]:
    _register_by(_fn, _sql, _number)


@query("q84_min_max_skip_nan", f"""
SELECT event_type, step_ts, round(min(value) FILTER (value < 50), 6) AS low,
       round(max(value) FILTER (value < 50), 6) AS high
FROM {HOURLY_SQL} GROUP BY ALL HAVING min(value) < 50""")
def min_max_skip_nan(spark, sf_dir):
    values = hourly(spark, sf_dir).withColumn(
        "value", F.when(F.col("value") < 50, F.col("value")).otherwise(F.lit(NAN)))
    low = op.aggregate(values, "min", by=["event_type"]).withColumnRenamed("value", "low")
    high = op.aggregate(values, "max", by=["event_type"]).withColumnRenamed("value", "high")
    return low.join(high, ["event_type", "step_ts"]).where(~F.isnan("low")).select(
        "event_type", "step_ts", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


def _ranked_sql(order: str) -> str:
    return f"""
SELECT series_key, step_ts, value, place FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, step_ts
                               ORDER BY value {order}, series_key)::INTEGER AS place
  FROM {HOURLY_SQL}) WHERE place <= 3"""


@query("q29_topk", _ranked_sql("DESC"))
def topk(spark, sf_dir):
    return op.topk(hourly(spark, sf_dir), 3, by=["event_type"]) \
        .select("series_key", "step_ts", "value", "place")


@query("q30_bottomk", _ranked_sql("ASC"))
def bottomk(spark, sf_dir):
    return op.bottomk(hourly(spark, sf_dir), 3, without=["user_id"]) \
        .select("series_key", "step_ts", "value", "place")


def _register_quantile(label: str, q: float) -> None:
    @query(f"q31_quantile_{label}", f"""
SELECT event_type, step_ts, round(quantile_cont(value, {q}), 6) AS value
FROM (SELECT event_type, {bucket('1 day')} AS step_ts, value FROM events) GROUP BY ALL""")
    def quantile(spark, sf_dir):
        points = op.at_steps(events_points(spark, sf_dir), "24h")
        return op.quantile(points, q, by=["event_type"]) \
            .withColumn("value", F.round("value", 6))


_register_quantile("median", 0.5)
_register_quantile("p90", 0.9)


@query("q85_quantile_lineitem", f"""
SELECT returnflag, step_ts, round(quantile_cont(value, 0.95), 6) AS value
FROM (SELECT l_returnflag AS returnflag, {bucket('7 days')} AS step_ts, value FROM {LINES})
GROUP BY ALL""")
def quantile_lineitem(spark, sf_dir):
    points = op.at_steps(lineitem_points(spark, sf_dir), "168h")
    return op.quantile(points, 0.95, by=["returnflag"]).withColumn("value", F.round("value", 6))


@query("q32_count_values", f"""
SELECT returnflag, step_ts, value, count(*) AS n
FROM (SELECT l_returnflag AS returnflag, {bucket('1 day')} AS step_ts, value FROM {LINES})
GROUP BY ALL""")
def count_values(spark, sf_dir):
    return op.count_values(op.at_steps(lineitem_points(spark, sf_dir), "24h"), by=["returnflag"])


@query("q86_step_sum_lineitem", f"""
SELECT linestatus, returnflag, step_ts, round(sum(value), 6) AS step_sum
FROM (SELECT l_linestatus AS linestatus, l_returnflag AS returnflag, {bucket('1 day')} AS step_ts,
             value FROM {LINES}) GROUP BY ALL""")
def step_sum_lineitem(spark, sf_dir):
    points = op.at_steps(lineitem_points(spark, sf_dir), "24h")
    tagged = points.select("*", *op.tag_columns(points, ["linestatus", "returnflag"]))
    return op.step_sum(tagged, by=["linestatus", "returnflag"]) \
        .withColumn("step_sum", F.round("step_sum", 6))


@query("q64_parents", f"""
SELECT parent, step_ts, round(sum(value), 6) AS step_sum FROM (
  SELECT 'events' AS parent, {bucket('1 day')} AS step_ts, value FROM {EVENTS}
  UNION ALL SELECT 'lineitem', {bucket('1 day')}, value FROM {LINES}) GROUP BY ALL""")
def parents(spark, sf_dir):
    """Two parents feed one operator; the blocks of each are summed on their own."""
    def daily(points):
        return op.at_steps(points, "24h").select("step_ts", "value")
    return compose.from_parents(
        {"events": daily(events_points(spark, sf_dir)),
         "lineitem": daily(lineitem_points(spark, sf_dir))}, op.step_sum) \
        .withColumn("step_sum", F.round("step_sum", 6))


@query("q65_children", f"""
SELECT step_ts, 'sum' AS child, round(sum(value), 6) AS value FROM {HOURLY_SQL} GROUP BY ALL
UNION ALL
SELECT step_ts, 'count', count(*)::DOUBLE FROM {HOURLY_SQL} GROUP BY ALL""")
def children(spark, sf_dir):
    """One source handed to two operators."""
    results = compose.to_children(hourly(spark, sf_dir), {
        "sum": lambda df: op.aggregate(df, "sum"), "count": lambda df: op.aggregate(df, "count")})
    return compose.union_all(
        df.select("step_ts", F.lit(label).alias("child"), F.round("value", 6).alias("value"))
        for label, df in results.items())


@query("q66_composed", f"""
SELECT step_ts, round(max(value), 6) AS value FROM (
  SELECT series_key, {bucket('1 day')} AS step_ts, sum(value) AS value FROM {LINES}
  WHERE returnflag <> 'N' GROUP BY ALL) GROUP BY ALL""".replace(
    "returnflag <>", "l_returnflag <>"))
def composed(spark, sf_dir):
    """A source function and operator functions, chained."""
    from tidegrid.functions.matchers import neq
    return compose.run(
        spark, lambda s: lineitem_points(s, sf_dir),
        lambda df: fetch(df, [neq("returnflag", "N")], "1990-01-01", "2010-01-01"),
        lambda df: consolidate(df, {"default": "24h"}, "sum"),
        lambda df: op.aggregate(df, "max"),
        lambda df: df.withColumn("value", F.round("value", 6)))


@query("q125_write_children", f"""
SELECT 'sum' AS child, event_type, step_ts, round(sum(value), 6) AS value FROM {HOURLY_SQL}
GROUP BY ALL
UNION ALL
SELECT 'max', event_type, step_ts, round(max(value), 6) FROM {HOURLY_SQL} GROUP BY ALL""")
def write_children(spark, sf_dir):
    """One vector, aggregated and written by two children."""
    root = scratch_path(spark, "children")
    compose.write_children(hourly(spark, sf_dir), {
        fn: lambda df, fn=fn: op.aggregate(df, fn, by=["event_type"]) for fn in ("sum", "max")},
        lambda label, df: df.write.parquet(f"{root}/child={label}"))
    return spark.read.parquet(root).select("child", "event_type", "step_ts",
                                           F.round("value", 6).alias("value"))
