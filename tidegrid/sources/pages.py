"""Paged answers of another site: pages with time bounds, of which only those needed are read.

A page is a folder of link records.  The list of pages, a small table of their numbers and bounds,
is read first; bounds of a query choose pages there, and one scan reads what is chosen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.times import Duration, Moment, from_millis, moment, to_millis, tumbling
from tidegrid.operators.fetch import in_range
from tidegrid.sources.points import DEFAULT_NAMESPACE
from tidegrid.sources.wire import WIRE_SERIES, series_to_points

PAGES = "page bigint, start_ms bigint, end_ms bigint, folder string"


def write_pages(points: DataFrame, root: str, width: Duration) -> None:
    """Points as pages of ``width``: one link record a sample, which keeps every time.

    Values go through 32 bits, times to milliseconds.  Samples without a time are in no page.
    """
    bounds = tumbling(F.col("ts"), width)
    page = to_millis(bounds.start).alias("page")
    records = points.where("ts is not null").select(
        "name", to_millis(F.col("ts")).alias("start_time"),
        F.array(F.col("value").cast("float")).alias("values"), "tags",
        F.lit("").alias("specification"), F.lit(1).alias("millis_per_step"), page)
    records.hint("rebalance", "page").write.partitionBy("page").parquet(f"{root}/pages")
    listed = points.where("ts is not null").select(page, to_millis(bounds.end).alias("end_ms")).distinct()
    listed.select("page", F.col("page").alias("start_ms"), "end_ms",
                  F.concat(F.lit("page="), F.col("page")).alias("folder")) \
        .write.json(f"{root}/list")


def page_list(spark: SparkSession, root: str, start: Moment | None = None,
              end: Moment | None = None) -> DataFrame:
    """Pages that may hold samples in ``[start, end)``."""
    listed = spark.read.schema(PAGES).json(f"{root}/list")
    if start is not None:
        listed = listed.where(from_millis(F.col("end_ms")) > moment(start))
    if end is not None:
        listed = listed.where(from_millis(F.col("start_ms")) < moment(end))
    return listed


def read_pages(spark: SparkSession, root: str, start: Moment | None = None, end: Moment | None = None,
               namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Points of the pages that ``[start, end)`` needs; no such page gives no points.

    The chosen folders, a name a page, pass through the driver as files of a scan always do; pages
    outside the bounds are not opened.
    """
    chosen = [r.folder for r in page_list(spark, root, start, end).select("folder").collect()]
    if chosen:
        series = spark.read.schema(WIRE_SERIES).parquet(*[f"{root}/pages/{f}" for f in sorted(chosen)])
    else:
        series = spark.createDataFrame([], WIRE_SERIES)
    points = series_to_points(series, namespace)
    if start is None and end is None:
        return points
    return in_range(points, start if start is not None else "0001-01-01",
                    end if end is not None else "9999-12-31")
