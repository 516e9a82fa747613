"""Kept rollups: a coarser namespace beside the raw table, of which only touched days are redone."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.times import Duration, micros_of, tumbling
from tidegrid.operators.fetch import cut_date
from tidegrid.operators.grid import fold
from tidegrid.sources.points import SERIES
from tidegrid.streaming.ingest import ALL_THERE_IS, _append, _batches, _exists

_DAY = 24 * 3600 * 1_000_000


def rollup(points: DataFrame, step: Duration, fn: str, namespace: str) -> DataFrame:
    """One sample a series and step, in ``namespace``, at the step's start.  A step divides a day."""
    if micros_of(step) <= 0 or _DAY % micros_of(step):
        raise ValueError(f"a rollup step divides a day, {step} does not")
    return points.groupBy("name", "series_key", "tags", tumbling(F.col("ts"), step).start.alias("ts")) \
        .agg(fold(fn, F.col("value"), F.col("ts")).alias("value")) \
        .select(F.lit(namespace).alias("namespace"), "name", "series_key", "tags", "ts", "value")


def touched_days(points: DataFrame) -> list:
    """The days with a sample, as dates.  Samples without a time touch none."""
    days = points.select(F.to_date("ts").alias("d")).where("d is not null").distinct().collect()
    return sorted(r.d for r in days)


def stored_days(stored: DataFrame, label: str) -> list:
    """The days that the batch ``label`` has in a points table, as dates."""
    days = stored.where(F.col("batch_id") == label).select(F.col("block_date").alias("d"))
    return sorted(r.d for r in days.where("d is not null").distinct().collect())


def refresh_rollup(spark: SparkSession, raw: str, target: str, step: Duration, fn: str,
                   namespace: str, days: Iterable | None = None) -> None:
    """Brings the rollup at ``target`` up to the points table at ``raw`` (cut by day).

    Only partitions of ``days`` (all, if None) are read and written, each replaced as a whole, so
    a refresh that runs twice changes nothing, and late samples are in after the refresh of their
    day.  Days whose samples are gone keep no rollup when they are named.
    """
    stored = spark.read.parquet(raw)
    if days is not None:
        stored = stored.where(F.col("block_date").isin(list(days)))
    made = rollup(stored, step, fn, namespace).withColumn("block_date", cut_date(F.col("ts"), "day"))
    made.hint("rebalance", "block_date").sortWithinPartitions("block_date", *SERIES, "ts") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("block_date").parquet(target)


def ingest_with_rollup(points: DataFrame, raw: str, target: str, checkpoint: str, step: Duration,
                       fn: str, namespace: str, promote: Sequence[str] = (),
                       trigger: dict = ALL_THERE_IS) -> StreamingQuery:
    """Appends a point stream to ``raw`` and keeps the rollup at ``target`` with it.

    After each batch the days that it touched are rolled up again from the raw table.  A batch that
    is run again does the same once more, to the same end.
    """
    def write(batch: DataFrame, label: str) -> None:
        spark = batch.sparkSession
        _append(batch, raw, label, promote)
        # the days come from the folders just written: nothing of the batch is kept or read for them
        days = stored_days(spark.read.parquet(raw), label) if _exists(spark, raw) else []
        if days:
            refresh_rollup(spark, raw, target, step, fn, namespace, days)
    return _batches(points, write, checkpoint, trigger)
