"""Point writes: one store, several stores, series dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.ids import fnv32a, fnv32a_rows
from tidegrid.functions.matchers import tag_column
from tidegrid.operators.fetch import CUTS, cut_date, series_of
from tidegrid.session import durable
from tidegrid.sources.stores import Store, StoreFilter, filter_stores, local_only

# Folds across namespaces group by these two, all others by these and more.
BUCKET_KEYS = ["name", "series_key"]
POINT_COLUMNS = ["namespace", "name", "series_key", "tags", "ts", "value"]


def layout(points: DataFrame, promote: Sequence[str] = (), keep: Sequence[str] = (),
           cut: str = "day") -> DataFrame:
    """Stored form: tags kept, a date column to cut the table by, and the tags named in
    ``promote`` also as ``tag_<name>`` columns, on which scans can filter."""
    return points.select(
        *POINT_COLUMNS, *keep,
        *[tag_column(t, points.columns).alias(f"tag_{t}") for t in promote],
        cut_date(F.col("ts"), cut).alias(CUTS[cut]))


def write_points(points: DataFrame, path: str, promote: Sequence[str] = (),
                 keep: Sequence[str] = (), mode: str = "append", cut: str = "day") -> None:
    """Append points, cut by day, month or year, sorted by series and time in each file.

    The rebalance hint lets Spark split a heavy date over several files and put light ones
    together.
    """
    if points is None:
        raise ValueError("nothing to write: no points given")
    column = CUTS[cut]
    layout(points, promote, keep, cut).hint("rebalance", column) \
        .sortWithinPartitions(column, "series_key", "ts") \
        .write.mode(mode).partitionBy(column).parquet(path)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(points: DataFrame, table: str, path: str, buckets: int = 64,
                   promote: Sequence[str] = (), keep: Sequence[str] = (), mode: str = "error") -> None:
    """Points as the catalogue table ``table`` at ``path``: bucketed by series, sorted by time.

    Folds, regrids and joins by series over it need no shuffle.  A bucket is read by one task, so
    take as many as make a bucket fit one; a table in which one series holds a large part is
    better cut by date (:func:`write_points`).
    """
    rows = points.select(*POINT_COLUMNS, *keep,
                         *[tag_column(t, points.columns).alias(f"tag_{t}") for t in promote])
    rows.repartition(buckets, *BUCKET_KEYS).write.mode(mode).format("parquet") \
        .bucketBy(buckets, *BUCKET_KEYS).sortBy(*BUCKET_KEYS, "ts") \
        .option("path", path).saveAsTable(table)


def write_series(points: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The series dimension, with ids, next to a stored points table."""
    series = series_of(points)
    series.withColumn("series_id", fnv32a(F.col("series_key"))) \
        .hint("rebalance").write.mode(mode).parquet(path)


def write_untagged(points: DataFrame, path: str, mode: str = "append",
                   cut: str = "day") -> None:
    """Points as (id, ts, value) alone.  The tags are not stored, so keep the series table
    of :func:`write_series` with it.

    The id is hashed row by row: a join with ids hashed once per series would move all
    samples across the network, and those of a hot series to one task.
    """
    points.select("namespace", fnv32a_rows(F.col("series_key")).cast("string").alias("id"), "ts",
                  "value", cut_date(F.col("ts"), cut).alias(CUTS[cut])) \
        .hint("rebalance", CUTS[cut]) \
        .write.mode(mode).partitionBy(CUTS[cut]).parquet(path)


def fanout_write(points: DataFrame, stores: Sequence[Store],
                 accept: StoreFilter = local_only, promote: Sequence[str] = ()) -> list[str]:
    """The same write to every accepted store, in order.  The first failure is raised;
    what was written before it stays.  Returns the labels written.

    For several stores the points are computed once, to the shared folder."""
    if points is None:
        raise ValueError("nothing to write: no points given")
    chosen = filter_stores(stores, accept)
    if len(chosen) > 1:
        points = durable(points)
    for store in chosen:
        write_points(points, store.path, promote)
    return [s.label for s in chosen]
