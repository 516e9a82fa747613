"""Vector matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.matchers import eq
from tidegrid.operators import aggregate as agg
from tidegrid.operators import vector as op
from tidegrid.operators.grid import consolidate
from tidegrid.plans.catalog.aggregates import HOURLY_SQL, hourly
from tidegrid.plans.catalog.common import LINES, bucket
from tidegrid.plans.registry import query
from tidegrid.sources.points import lineitem_points

# per step and event type, the sum over all users
_BY_TYPE = f"""(SELECT event_type, step_ts, sum(value) AS value FROM {HOURLY_SQL} GROUP BY ALL)"""
_BY_USER = f"""(SELECT user_id, step_ts, sum(value) AS value FROM {HOURLY_SQL} GROUP BY ALL)"""


def rounded():
    return F.round("value", 6).alias("value")



def by_tag(spark, sf_dir, tag):
    return op.vector(agg.aggregate(hourly(spark, sf_dir), "sum", by=[tag]), [tag])


def one_type(spark, sf_dir, event_type):
    return hourly(spark, sf_dir, [eq("event_type", event_type)])


@query("q109_number_left", f"""
SELECT 'event_type=' || event_type || ',user_id=' || user_id || ',' AS series_key, step_ts,
       '' AS name, round(100 - value, 6) AS value FROM {HOURLY_SQL}
UNION ALL
SELECT 'event_type=' || event_type || ',user_id=' || user_id || ',', step_ts, 'events', value
FROM {HOURLY_SQL} WHERE 5 < value""")
def number_left(spark, sf_dir):
    """A number on the left: arithmetic drops the name, a filtering comparison keeps it."""
    values = hourly(spark, sf_dir)
    both = op.scalar_left(100, "-", values).unionByName(op.scalar_left(5, "<", values))
    return both.select("series_key", "step_ts", "name", rounded())


_ARITHMETIC_SQL = {
    "+": "a.value + b.value", "-": "a.value - b.value", "*": "a.value * b.value",
    "/": "a.value / b.value", "%": "a.value % b.value", "^": "power(a.value, b.value / 1000)"}
_NAMES = {"+": "add", "-": "sub", "*": "mul", "/": "div", "%": "mod", "^": "pow"}


def _register_arithmetic(sign: str, sql: str) -> None:
    digits = 4 if sign in "*^" else 6

    @query(f"q35_vector_{_NAMES[sign]}", f"""
SELECT 'user_id=' || user_id || ',' AS series_key, step_ts, round({sql}, {digits}) AS value
FROM (SELECT user_id, step_ts, value FROM {HOURLY_SQL} WHERE event_type = 'click') a
JOIN (SELECT user_id, step_ts, value FROM {HOURLY_SQL} WHERE event_type = 'view') b
USING (user_id, step_ts)""")
    def vector_arithmetic(spark, sf_dir):
        clicks, views = (one_type(spark, sf_dir, t) for t in ("click", "view"))
        if sign == "^":
            views = op.scalar(views, "/", 1000)
        return op.one_to_one(clicks, views, sign, ignoring=["event_type"]) \
            .select("series_key", "step_ts", F.round("value", digits).alias("value"))


for _sign, _sql in _ARITHMETIC_SQL.items():
    _register_arithmetic(_sign, _sql)


@query("q36_group_left", f"""
SELECT series_key, step_ts, round(a.value / b.value, 6) AS value
FROM {HOURLY_SQL} a JOIN {_BY_TYPE} b USING (event_type, step_ts)""")
def group_left(spark, sf_dir):
    """Each series' share in the sum of its event type."""
    return op.group_left(hourly(spark, sf_dir), by_tag(spark, sf_dir, "event_type"), "/",
                         on=["event_type"]).select("series_key", "step_ts", rounded())


@query("q87_group_right", f"""
SELECT 'event_type=' || event_type || ',returnflag=R,user_id=' || user_id || ',' AS series_key,
       step_ts, round(b.value - a.value, 6) AS value
FROM {_BY_USER} b JOIN {HOURLY_SQL} a USING (user_id, step_ts)""")
def group_right(spark, sf_dir):
    """The sum of a user less each of the user's series, with a tag taken from the one side."""
    one = by_tag(spark, sf_dir, "user_id").withColumn("tags", F.map_concat(
        "tags", F.create_map(F.lit("returnflag"), F.lit("R"))))
    return op.group_right(one, hourly(spark, sf_dir), "-", on=["user_id"],
                          include=["returnflag"]).select("series_key", "step_ts", rounded())


_CLICKS = f"(SELECT * FROM {HOURLY_SQL} WHERE event_type = 'click')"
_BIG = f"(SELECT * FROM {HOURLY_SQL} WHERE value > 100)"


def _sides(spark, sf_dir):
    clicks = one_type(spark, sf_dir, "click")
    big = op.scalar(hourly(spark, sf_dir), ">", 100)
    return clicks, big.select(*clicks.columns)


@query("q37_and", f"""
SELECT series_key, step_ts, value FROM {_CLICKS} a
WHERE EXISTS (SELECT 1 FROM {_BIG} b WHERE a.user_id = b.user_id AND a.step_ts = b.step_ts)""")
def vector_and(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return op.vector_and(left, right, on=["user_id"]).select("series_key", "step_ts", "value")


@query("q38_or", f"""
SELECT series_key, step_ts, value FROM {_CLICKS}
UNION ALL
SELECT series_key, step_ts, value FROM {_BIG} b
WHERE NOT EXISTS (SELECT 1 FROM {_CLICKS} a WHERE a.user_id = b.user_id AND a.step_ts = b.step_ts)
""")
def vector_or(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return op.vector_or(left, right, on=["user_id"]).select("series_key", "step_ts", "value")


@query("q39_unless", f"""
SELECT series_key, step_ts, value FROM {_CLICKS} a
WHERE NOT EXISTS (SELECT 1 FROM {_BIG} b WHERE a.user_id = b.user_id AND a.step_ts = b.step_ts)""")
def vector_unless(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return op.vector_unless(left, right, ignoring=["event_type"]) \
        .select("series_key", "step_ts", "value")


_COMPARE_NAMES = {"==": "eq", "!=": "ne", "<": "lt", "<=": "le", ">": "gt", ">=": "ge"}


def _register_comparison(sign: str, name: str) -> None:
    sql = {"==": "=", "!=": "<>"}.get(sign, sign)

    @query(f"q40_compare_{name}", f"""
SELECT series_key, step_ts, value FROM {HOURLY_SQL} WHERE value {sql} 12.31""")
    def compare(spark, sf_dir):
        return op.scalar(hourly(spark, sf_dir), sign, 12.31) \
            .select("series_key", "step_ts", "value")


for _sign, _name in _COMPARE_NAMES.items():
    _register_comparison(_sign, _name)


@query("q88_compare_bool", f"""
SELECT 'user_id=' || user_id || ',' AS series_key, step_ts,
       (a.value >= b.value)::INTEGER::DOUBLE AS value
FROM (SELECT user_id, step_ts, value FROM {HOURLY_SQL} WHERE event_type = 'click') a
JOIN (SELECT user_id, step_ts, value FROM {HOURLY_SQL} WHERE event_type = 'view') b
USING (user_id, step_ts)""")
def compare_bool(spark, sf_dir):
    return op.one_to_one(one_type(spark, sf_dir, "click"), one_type(spark, sf_dir, "view"), ">=",
                         on=["user_id"], bool_result=True) \
        .select("series_key", "step_ts", "value")


@query("q89_share_lineitem", f"""
WITH daily AS (SELECT series_key, l_returnflag, {bucket('7 days')} AS step_ts, sum(value) AS value
               FROM {LINES} GROUP BY ALL),
     total AS (SELECT l_returnflag, step_ts, sum(value) AS total FROM daily GROUP BY ALL)
SELECT series_key, step_ts, round(value / total, 6) AS value
FROM daily JOIN total USING (l_returnflag, step_ts)""")
def share_lineitem(spark, sf_dir):
    """Three hot match keys: every series of a return flag against the flag's total."""
    tags = ["linestatus", "returnflag", "suppkey"]
    points = lineitem_points(spark, sf_dir, keep=[])
    tagged = points.select("*", *agg.tag_columns(points, tags))
    weekly = op.vector(consolidate(tagged, {"default": "168h"}, "sum", by=tags), tags)
    total = op.vector(agg.aggregate(weekly, "sum", by=["returnflag"]), ["returnflag"])
    return op.group_left(weekly, total, "/", on=["returnflag"]) \
        .select("series_key", "step_ts", rounded())
