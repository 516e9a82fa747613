"""Nested and JSON results, batches of write requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.ids import tags_to_labels
from tidegrid.functions.times import Duration, to_millis, tumbling
from tidegrid.operators.grid import regrid
from tidegrid.operators.position import with_position
from tidegrid.sources.points import SERIES

PART_SAMPLES = 10_000


def nest_series(grid: DataFrame, keys: Sequence[str] = SERIES,
                part_samples: int = PART_SAMPLES) -> DataFrame:
    """A grid (step_idx, step_ts, value, tags) as records labels[] + samples[].

    A series of up to ``part_samples`` samples is one record, ``part`` 0.  A longer one
    goes on in further parts, whose samples follow on: no row grows with the data.
    """
    part = F.call_function("div", F.col("step_idx"), F.lit(part_samples)).alias("part")
    sample = F.struct(F.col("step_idx"), to_millis(F.col("step_ts")).alias("timestamp"), "value")
    nested = grid.groupBy(*keys, part).agg(
        F.array_sort(F.collect_list(sample)).alias("cells"), F.first("tags").alias("tags"))
    return nested.select(
        *keys, "part", tags_to_labels(F.col("tags")).alias("labels"),
        F.transform("cells", lambda c: F.struct(c["value"].alias("value"),
                                                c["timestamp"].alias("timestamp")))
        .alias("samples"))


def nest_result(points: DataFrame, start, step: Duration, tie: Sequence[str] = (),
                part_samples: int = PART_SAMPLES, slices: int | None = None) -> DataFrame:
    """A fetch result as nested records; sample i is stamped ``start + i * step``."""
    return nest_series(regrid(points, start, step, tie, slices=slices),
                       part_samples=part_samples)


def bounded_parts(points: DataFrame, keys: Sequence[str], tie: Sequence[str] = (),
                  max_samples: int = PART_SAMPLES, block: Duration = "24h") -> DataFrame:
    """``points`` with ``part``: runs of at most ``max_samples`` samples of each of ``keys`` in time
    order.  Gathering a part, not a key, makes rows that no hot key can fill."""
    placed = with_position(points, keys, ["ts", *tie], tumbling(F.col("ts"), block).start,
                           out="__place")
    part = F.call_function("div", F.col("__place"), F.lit(max_samples))
    return placed.withColumn("part", part).drop("__place")


def write_requests_of(points: DataFrame, tie: Sequence[str] = (),
                      max_samples: int = PART_SAMPLES) -> DataFrame:
    """Points as write requests (labels, samples): a series goes on in further requests after
    ``max_samples``, in time order."""
    sample = F.struct(F.col("ts"), F.struct("value", to_millis(F.col("ts")).alias("timestamp"))
                      .alias("s"))
    parts = bounded_parts(points, SERIES, tie, max_samples).groupBy(*SERIES, "part").agg(
        F.first("tags").alias("tags"), F.array_sort(F.collect_list(sample)).alias("cells"))
    return parts.select(tags_to_labels(F.col("tags")).alias("labels"),
                        F.col("cells.s").alias("samples"))


def batches(requests: DataFrame, size: int, order: Sequence[str], bucket: Column,
            slices: int | None = None) -> DataFrame:
    """Write requests in groups of ``size`` by ``order``, the rest last: (batch_id,
    n_series, timeseries).  ``bucket`` must not fall while ``order`` rises."""
    if size < 1:
        raise ValueError("batch size must be positive")
    placed = with_position(requests, [], order, bucket, out="place", slices=slices)
    batch = F.call_function("div", F.col("place"), F.lit(size)).alias("batch_id")
    series = F.struct("place", "labels", "samples")
    return placed.groupBy(batch).agg(F.array_sort(F.collect_list(series)).alias("ts")) \
        .select("batch_id", F.size("ts").alias("n_series"),
                F.transform("ts", lambda t: F.struct(t["labels"].alias("labels"),
                                                     t["samples"].alias("samples")))
                .alias("timeseries"))


def time_batches(points: DataFrame, size: int, tie: Sequence[str] = ()) -> DataFrame:
    """Batches of single-sample write requests in time order."""
    requests = points.select(
        tags_to_labels(F.col("tags")).alias("labels"),
        F.array(F.struct(F.col("value"), to_millis(F.col("ts")).alias("timestamp")))
        .alias("samples"), "ts", *tie)
    return batches(requests, size, ["ts", *tie], tumbling(F.col("ts"), "1m").start)


def write_batches(requests: DataFrame, path: str, size: int) -> None:
    """Write requests as files of at most ``size`` records, order free."""
    requests.write.option("maxRecordsPerFile", size).parquet(path)


def search_json(metrics: DataFrame) -> DataFrame:
    """Search result rows (namespace, id, tags) as one JSON text each."""
    return metrics.select(F.to_json(F.struct("namespace", "id", "tags")).alias("json"))


def write_search_json(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    metrics.select("namespace", "id", "tags").write.mode(mode).json(path)


def result_json(nested: DataFrame) -> DataFrame:
    """Nested result records as JSON text."""
    return nested.select(F.to_json(F.struct("labels", "samples"),
                                   {"ignoreNullFields": "false"}).alias("json"))
