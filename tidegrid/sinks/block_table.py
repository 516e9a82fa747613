"""Columnar block table: value arrays on a fixed step, read by step and by series.

A row holds one block of time and at most ``series_per_row`` series: their keys, and the values of
all their steps in one array, series after series.  Both readers work on the same rows: a series is
a slice of the array, a step every ``width``-th value of it.  A row is bounded by its series and
steps, whatever the number of samples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.functions.times import Duration, interval, micros_of, step_millis, tumbling
from tidegrid.operators.fetch import cut_date
from tidegrid.operators.grid import fold
from tidegrid.sources.points import SERIES

_KEYS = "array<struct<namespace:string,name:string,series_key:string,tags:map<string,string>>>"
SCHEMA = f"block_start timestamp_ntz, part long, millis_per_step long, width int, keys {_KEYS}, " \
    "values array<double>, block_date date"


def _filled(width: int):
    """Puts the (step, value) pairs of each series in place; the rest is NaN."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cells")
            per_row = np.diff(cells.offsets.to_numpy())
            series = cells.flatten()
            sizes = np.diff(series.offsets.to_numpy())
            flat = series.flatten()
            step = flat.field("step").to_numpy(zero_copy_only=False).astype(np.int64)
            out = np.full(len(sizes) * width, np.nan)
            out[np.repeat(np.arange(len(sizes)), sizes) * width + step] = \
                flat.field("value").to_numpy(zero_copy_only=False)
            ends = np.r_[0, np.cumsum(per_row) * width].astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(ends), pa.array(out))
            names = ["block_start", "part", "keys"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [values],
                                             names=[*names, "values"])
    return run


def block_rows(points: DataFrame, step: Duration, block: Duration = "24h", fn: str = "last",
               series_per_row: int = 64, groups: int = 1024) -> DataFrame:
    """``points`` as rows of the table; see :data:`SCHEMA`.

    Samples of one step are folded by ``fn``; a step without samples is NaN.  Samples without a time
    have no block and are left out.  Series are dealt over ``groups`` by hash, and a group of more
    than ``series_per_row`` is cut into parts, so ``groups`` only decides how full rows are.
    """
    width, odd = divmod(micros_of(block), micros_of(step))
    if odd:
        raise ValueError(f"a block of {block} is no whole number of steps of {step}")
    at = tumbling(F.col("ts"), block).start
    cut = points.where("ts is not null").withColumn("block_start", at)
    index = F.call_function("div", F.col("ts") - F.col("block_start"), interval(step)).cast("int")
    cells = cut.groupBy(*SERIES, "tags", "block_start", index.alias("step")) \
        .agg(fold(fn, F.col("value"), F.col("ts")).alias("value"))
    # a series has at most ``width`` cells in a block, a group's series come in parts
    series = cells.groupBy(*SERIES, "tags", "block_start").agg(
        F.collect_list(F.struct("step", "value")).alias("cells"))
    group = F.pmod(F.xxhash64(*SERIES), F.lit(groups)).alias("group")
    # a group of one block has as many series as ``groups`` leaves it
    place = F.row_number().over(Window.partitionBy("block_start", "group").orderBy(*SERIES))
    placed = series.withColumn("group", group).withColumn("place", place - 1)
    part = F.col("group") + F.lit(groups) * F.call_function(
        "div", F.col("place").cast("long"), F.lit(series_per_row))
    member = F.struct(F.col("place"), F.struct(*SERIES, "tags").alias("key"), F.col("cells"))
    rows = placed.groupBy("block_start", part.alias("part")) \
        .agg(F.collect_list(member).alias("members")) \
        .select("block_start", "part", F.col("members.key").alias("keys"),
                F.col("members.cells").alias("cells"))
    filled = rows.mapInArrow(_filled(width),
                             f"block_start timestamp_ntz, part long, keys {_KEYS}, values array<double>")
    return filled.select("block_start", "part", F.lit(step_millis(step)).cast("long").alias("millis_per_step"),
                         F.lit(width).alias("width"), "keys", "values",
                         cut_date(F.col("block_start"), "day").alias("block_date"))


def write_block_table(points: DataFrame, path: str, step: Duration, block: Duration = "24h",
                      fn: str = "last", series_per_row: int = 64, groups: int = 1024,
                      mode: str = "error") -> None:
    """Stores :func:`block_rows`, cut by the day in which a block begins."""
    block_rows(points, step, block, fn, series_per_row, groups) \
        .write.mode(mode).partitionBy("block_date").parquet(path)


def read_block_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def blocks_by_series(table: DataFrame) -> DataFrame:
    """One row a series and block: its keys, block_start, millis_per_step, values."""
    each = table.select("block_start", "millis_per_step", "width", "values",
                        F.posexplode("keys").alias("pos", "key"))
    return each.select("key.*", "block_start", "millis_per_step",
                       F.slice("values", F.col("pos") * F.col("width") + 1, F.col("width"))
                       .alias("values"))


def _cells(table: DataFrame, *more: str) -> DataFrame:
    each = table.select("block_start", "millis_per_step", "width", *more,
                        F.posexplode("values").alias("pos", "value"))
    step = F.col("pos") % F.col("width")
    ts = F.col("block_start") + F.make_dt_interval(
        secs=step.cast("decimal(18,6)") * F.col("millis_per_step") / 1000)
    return each.withColumn("step", step).withColumn("step_ts", ts.cast("timestamp_ntz"))


def blocks_by_step(table: DataFrame) -> DataFrame:
    """One row a step: how many series have a value there, and the sum over them."""
    real = _cells(table).where(~F.isnan("value"))
    return real.groupBy("step_ts").agg(F.count("value").alias("n_values"),
                                       F.sum("value").alias("value_sum"))


def table_points(table: DataFrame) -> DataFrame:
    """The values as points again, one a step that has one, at the step's start."""
    cells = _cells(table, "keys").where(~F.isnan("value"))
    key = F.col("keys")[F.call_function("div", F.col("pos"), F.col("width")).cast("int")]
    return cells.select(key.alias("key"), F.col("step_ts").alias("ts"), "value") \
        .select("key.*", "ts", "value")
