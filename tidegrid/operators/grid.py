"""Positional regridding, dense grids, consolidation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.times import (Duration, Moment, interval, micros_of, moment,
                                      step_index, step_millis, step_time, tumbling)
from tidegrid.functions.values import nan_for_null
from tidegrid.operators.fetch import in_range
from tidegrid.operators.position import with_position
from tidegrid.sources.points import SERIES, distinct_rows

# steps of an empty grid made from one row
RUN = 10_000


def regrid(points: DataFrame, start: Moment, step: Duration, tie: Sequence[str] = (),
           block: Duration = "24h", keys: Sequence[str] = SERIES,
           slices: int | None = None, whole: bool = False) -> DataFrame:
    """The i-th sample of a series becomes step i, at ``start + i * step``; sample times
    are replaced.  ``tie`` orders samples of equal time, their other columns those equal in it
    too.  A series is numbered block by block; ``slices`` is for blocks too long for a task,
    ``whole`` for tables bucketed by series, which then need no shuffle."""
    placed = with_position(points, keys, ["ts", *tie], tumbling(F.col("ts"), block).start,
                           out="step_idx", slices=slices, whole=whole)
    return placed.withColumn("step_ts", step_time(F.col("step_idx"), start, step))


def fold(fn: str, value: Column, ts: Column) -> Column:
    """A consolidation fold by name.  ``min``/``max`` skip NaN, the sums do not; ``last``
    takes the latest sample.  Null values take no part."""
    present = F.when(~F.isnan(value), value)
    folds = {
        "sum": lambda: F.sum(value),
        "avg": lambda: F.avg(value),
        "count": lambda: F.count(value).cast("double"),
        "min": lambda: nan_for_null(F.min(present)),
        "max": lambda: nan_for_null(F.max(present)),
        # of samples at the same time the largest value, NaN above all, whatever comes first
        "last": lambda: F.max_by(value, F.when(value.isNotNull(), F.struct(ts, value))),
    }
    if fn not in folds:
        raise ValueError(f"unknown fold {fn!r}, expecting one of {', '.join(sorted(folds))}")
    return folds[fn]()


def cell_aggregates(namespaces: Sequence[str], fn: str, value: Column,
                    ts: Column) -> list[Column]:
    """One aggregate per namespace for :func:`cell_value`: its fold, its number of samples, and
    for ``last`` its latest time.  All of them share one shuffle, and run on streams."""
    made = []
    for i, namespace in enumerate(namespaces):
        own = F.col("namespace") == namespace
        mine = F.when(own, value)
        latest = [F.max(F.when(own, ts)).alias("ts")] if fn == "last" else []
        made.append(F.struct(F.count(mine).alias("n"), *latest,
                             fold(fn, mine, ts).alias("value")).alias(f"_cell{i}"))
    return made


def cell_value(namespaces: Sequence[str], fn: str) -> Column:
    """The fold ``fn`` over one value per namespace, of those that have samples."""
    cells = F.filter(F.array(*[F.col(f"_cell{i}") for i in range(len(namespaces))]),
                     lambda c: c["n"] > 0)
    values = F.transform(cells, lambda c: c["value"])
    present = F.filter(values, lambda v: ~F.isnan(v))
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return {"sum": lambda: total, "avg": lambda: total / F.size(values),
            "count": lambda: F.size(values).cast("double"),
            "min": lambda: nan_for_null(F.array_min(present)),
            "max": lambda: nan_for_null(F.array_max(present)),
            "last": lambda: F.array_max(F.transform(
                cells, lambda c: F.struct(c["ts"], c["value"])))["value"]}[fn]()


def consolidate(points: DataFrame, resolutions: dict[str, Duration], fn: str,
                by: Sequence[str] = ("name", "series_key"), flat: bool = False) -> DataFrame:
    """Bring all namespaces to the coarsest resolution among them and fold each cell.

    ``resolutions`` lists the namespaces taken part; samples of others are left out.  A cell
    is first folded for each namespace, then ``fn`` runs over one value per namespace, so raw
    samples and their rollup do not add up sample by sample; ``count`` then is the number of
    namespaces present.  ``flat`` folds the samples of all namespaces as one lot instead.
    Result: ``by`` columns, ``step_ts``, ``value``.
    """
    if not resolutions:
        raise ValueError("no namespace given")
    names = sorted(resolutions)
    kept = points.where(F.col("namespace").isin(names))
    cells = kept.groupBy(*by, tumbling(F.col("ts"), coarsest(resolutions)).start
                         .alias("step_ts"))
    # a sum of one value is that value: one namespace needs no second fold
    if flat or (len(names) == 1 and fn != "count"):
        return cells.agg(fold(fn, F.col("value"), F.col("ts")).alias("value"))
    return cells.agg(*cell_aggregates(names, fn, F.col("value"), F.col("ts"))) \
        .select(*by, "step_ts", cell_value(names, fn).alias("value"))


def coarsest(resolutions: dict[str, Duration]) -> Duration:
    return max(resolutions.values(), key=micros_of)


def consolidate_custom(points: DataFrame, resolutions: dict[str, Duration], within: str,
                       zero: float, merge,
                       by: Sequence[str] = ("name", "series_key")) -> DataFrame:
    """A caller's fold across namespaces: ``merge(existing, to_add, count) -> Column``.

    Each namespace is first folded to the coarsest resolution with the named fold
    ``within``; ``merge`` then runs over one value per namespace, in namespace order, with
    the number merged so far.  Only that short list is ever gathered.
    """
    cells = consolidate(points, resolutions, within, by=[*by, "namespace"], flat=True)
    gathered = cells.groupBy(*by, "step_ts").agg(
        F.array_sort(F.collect_list(F.struct("namespace", "value"))).alias("parts"))
    state = F.struct(F.lit(float(zero)).alias("v"), F.lit(0).cast("bigint").alias("n"))
    folded = F.aggregate(
        "parts", state,
        lambda acc, s: F.struct(merge(acc["v"], s["value"], acc["n"]).cast("double").alias("v"),
                                (acc["n"] + 1).alias("n")),
        lambda acc: acc["v"])
    return gathered.select(*by, "step_ts", folded.alias("value"))


def dense_grid(points: DataFrame, start: Moment, end: Moment, step: Duration,
               fn: str = "last", by: Sequence[str] = ("name", "series_key")) -> DataFrame:
    """Every series on every step of ``[start, end)``; cells without samples hold NaN.

    Result: ``by`` columns, ``step_idx``, ``step_ts``, ``value``.  The empty grid and the
    samples meet in one aggregation, so samples are folded before they are shuffled.
    """
    window = in_range(points, start, end)
    cells = window.select(*by, step_index(F.col("ts"), start, step).alias("step_idx"),
                          "ts", "value", F.lit(1).alias("real"))
    # the last step that begins before the end
    last = step_index(moment(end) - interval("1us"), start, step)
    # in runs: no row holds the steps of a whole grid
    runs = distinct_rows(window, *by).select(*by, F.explode(F.sequence(
        F.lit(0).cast("bigint"), last, F.lit(RUN).cast("bigint"))).alias("run"))
    empty = runs.select(
        *by, F.explode(F.sequence("run", F.least(F.col("run") + RUN - 1, last)))
        .alias("step_idx"),
        F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("int").alias("real"))
    grid = cells.unionByName(empty).groupBy(*by, "step_idx").agg(
        fold(fn, F.col("value"), F.col("ts")).alias("value"), F.count("real").alias("real"))
    value = nan_for_null(F.when(F.col("real") > 0, F.col("value")))
    return grid.select(*by, "step_idx", step_time(F.col("step_idx"), start, step)
                       .alias("step_ts"), value.alias("value"))


def slice_steps(grid: DataFrame, begin: int, end: int) -> DataFrame:
    """Cells ``[begin, end)`` of a grid."""
    return grid.where((F.col("step_idx") >= begin) & (F.col("step_idx") < end))


def value_at_step(grid: DataFrame, n: int) -> DataFrame:
    return grid.where(F.col("step_idx") == n)


def missing_series(grid: DataFrame, by: Sequence[str] = ("name", "series_key")) -> DataFrame:
    """Per series: whether every value is NaN."""
    return grid.groupBy(*by).agg(F.every(F.isnan("value")).alias("all_nan"))


def all_missing(points: DataFrame) -> DataFrame:
    """One row: whether every value is NaN; true for no rows."""
    return points.agg(F.coalesce(F.every(F.isnan("value")), F.lit(True)).alias("all_nan"))


def series_values(grid: DataFrame, step: Duration, max_steps: int = 10_000,
                  by: Sequence[str] = ("name", "series_key")) -> DataFrame:
    """Arrays of a grid: per series, parts of at most ``max_steps`` values in step order,
    with the time of the first one."""
    part = F.call_function("div", F.col("step_idx"), F.lit(max_steps)).alias("part")
    cells = F.array_sort(F.collect_list(F.struct("step_idx", "value")))
    return grid.groupBy(*by, part).agg(F.min("step_ts").alias("start_time"),
                                       cells.alias("cells")) \
        .select(*by, "part", "start_time", F.lit(step_millis(step)).alias("millis_per_step"),
                F.transform("cells", lambda c: c["value"]).alias("values"))

