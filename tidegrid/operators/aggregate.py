"""Aggregation across series per time step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.ids import key_text
from tidegrid.functions.matchers import tag_column
from tidegrid.functions.times import Duration, tumbling
from tidegrid.functions.values import nan_for_null
from tidegrid.operators.position import with_position

# How many ways a group is sliced for a top-k too long to be cut ahead of the shuffle.
SLICES = 1024


def step_sum(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of the values of all series at each step; NaN carries through."""
    return points.groupBy(*by, "step_ts").agg(F.sum("value").alias("step_sum"))


def step_count(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of values at each step."""
    return points.groupBy(*by, "step_ts").agg(F.count("value").alias("step_count"))


def at_steps(points: DataFrame, size: Duration) -> DataFrame:
    """Add ``step_ts``, the start of the tumbling window a sample falls in."""
    return points.withColumn("step_ts", tumbling(F.col("ts"), size).start)


def tag_columns(points: DataFrame, labels: Sequence[str]) -> list[Column]:
    return [tag_column(label, points.columns).alias(label) for label in labels]


def group_columns(points: DataFrame, by: Sequence[str] | None = None,
                  without: Sequence[str] | None = None) -> list[Column]:
    """Grouping columns: the ``by`` tags as columns of that name; or, for ``without``, the
    key text of the remaining tags as ``group_key``; or none."""
    if by is not None and without is not None:
        raise ValueError("give by or without, not both")
    if without is not None:
        dropped = list(without)
        rest = F.map_filter("tags", lambda k, v: ~k.isin(dropped)) if dropped else F.col("tags")
        return [key_text(rest).alias("group_key")]
    return tag_columns(points, by or [])


def _present(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


# Aggregators over the vector of one step.  min and max skip NaN, the others keep it.
AGGREGATORS = {
    "sum": F.sum,
    "avg": F.avg,
    "count": lambda v: F.count(v).cast("double"),
    "min": lambda v: nan_for_null(F.min(_present(v))),
    "max": lambda v: nan_for_null(F.max(_present(v))),
    "stddev": F.stddev_pop,
    "stdvar": F.var_pop,
}


def aggregate(points: DataFrame, fn: str, by: Sequence[str] | None = None,
              without: Sequence[str] | None = None) -> DataFrame:
    """``fn`` per group and step: grouping columns, ``step_ts``, ``value``.

    Every one has a partial form, so a hot group reaches the shuffle as one row per task.
    """
    if fn not in AGGREGATORS:
        raise ValueError(f"unknown aggregator {fn!r}, expecting one of "
                         + ", ".join(sorted(AGGREGATORS)))
    return points.groupBy(*group_columns(points, by, without), "step_ts") \
        .agg(AGGREGATORS[fn](F.col("value")).alias("value"))


def count_values(points: DataFrame, by: Sequence[str] | None = None,
                 without: Sequence[str] | None = None) -> DataFrame:
    """How often each value occurs per group and step."""
    return points.groupBy(*group_columns(points, by, without), "step_ts", "value") \
        .agg(F.count(F.lit(1)).alias("n"))


def _ranked(points: DataFrame, k: int, largest: bool, by: Sequence[str] | None,
            without: Sequence[str] | None, tie: Sequence[str]) -> DataFrame:
    groups = group_columns(points, by, without)
    names = [f"__g{i}" for i in range(len(groups))]
    out = points.select("*", *[g.alias(n) for g, n in zip(groups, names)])
    value = F.col("value").desc() if largest else F.col("value").asc()
    # NaN ranks behind every number on both ends
    order = [F.isnan("value").asc(), value, "name", "series_key", *tie]
    limit = int(points.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > limit:
        # up to the limit Spark cuts each group to k rows ahead of the shuffle by itself;
        # beyond it, rank slices of the group first, so that no task sorts a whole hot one
        salt = F.pmod(F.xxhash64("series_key", "value", *tie), F.lit(SLICES))
        inside = Window.partitionBy(*names, "step_ts", "__salt").orderBy(*order)
        out = out.withColumn("__salt", salt).withColumn("__part", F.row_number().over(inside)) \
            .where(F.col("__part") <= k)
    place = F.row_number().over(Window.partitionBy(*names, "step_ts").orderBy(*order))
    return out.withColumn("place", place).where(F.col("place") <= k) \
        .select(*points.columns, "place")


def topk(points: DataFrame, k: int, by: Sequence[str] | None = None,
         without: Sequence[str] | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` largest values per group and step, with their series and ``place``."""
    return _ranked(points, k, True, by, without, tie)


def bottomk(points: DataFrame, k: int, by: Sequence[str] | None = None,
            without: Sequence[str] | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` smallest values per group and step."""
    return _ranked(points, k, False, by, without, tie)


def _magnitude(value: Column) -> Column:
    """A bucket that never falls while the value rises, NaN first; about 0.1 % wide."""
    size = F.floor(F.log1p(F.abs(value)) * 1024)
    return F.when(F.isnan(value), F.lit(-(1 << 40))).otherwise(F.signum(value).cast("bigint")
                                                              * F.least(size, F.lit(1 << 39)))


def quantile(points: DataFrame, q: float, by: Sequence[str] | None = None,
             without: Sequence[str] | None = None, slices: int | None = None) -> DataFrame:
    """The exact ``q`` quantile with linear interpolation, per group and step.

    Equal values are counted before the shuffle and the counts are ranked in buckets, so
    neither a large group nor one repeated value fills a task.  NaN is the lowest value;
    below 0 and above 1 the result is infinite.
    """
    groups = group_columns(points, by, without)
    if q < 0 or q > 1:
        edge = float("-inf") if q < 0 else float("inf")
        return points.groupBy(*groups, "step_ts").agg(F.lit(edge).alias("value"))
    grouped = points.select(*groups, "step_ts", "value")
    keys = [c for c in grouped.columns if c != "value"]
    counted = grouped.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("real", ~F.isnan("value"))
    placed = with_position(counted, keys, ["real", "value"], _magnitude(F.col("value")),
                           out="before", weight="n", total_out="size", slices=slices)
    rank = F.lit(float(q)) * (F.col("size") - 1)

    def covers(at: Column) -> Column:
        return (F.col("before") <= at) & (at < F.col("before") + F.col("n"))

    ends = placed.withColumn("rank", rank) \
        .withColumn("low", F.when(covers(F.floor("rank")), F.col("value"))) \
        .withColumn("high", F.when(covers(F.ceil("rank")), F.col("value"))) \
        .where(F.col("low").isNotNull() | F.col("high").isNotNull())
    picked = ends.groupBy(*keys).agg(
        F.max("low").alias("low"), F.max("high").alias("high"), F.max("rank").alias("rank"))
    part = F.col("rank") - F.floor("rank")
    value = F.when(part == 0, F.col("low")).otherwise(
        F.col("low") * (F.lit(1.0) - part) + F.col("high") * part)
    return picked.select(*keys, value.alias("value"))
