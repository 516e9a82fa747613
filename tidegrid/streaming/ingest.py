"""The write feed as Structured Streaming jobs: ingest, admission, retention,
consolidation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.ids import fnv32a
from tidegrid.functions.times import (Duration, Moment, as_timedelta, epoch, interval, moment,
                                      stream_window, to_micros, window_text)
from tidegrid.operators.fetch import CUTS, cut_date, series_of
from tidegrid.operators.grid import cell_aggregates, cell_value, coarsest, fold
from tidegrid.sinks.points import POINT_COLUMNS, layout
from tidegrid.sources.points import SERIES
from tidegrid.sources.stores import Store, StoreFilter, filter_stores, local_only
from tidegrid.sources.wire import (WRITE_MESSAGE, WRITE_REQUEST, write_message_points,
                                   write_request_points)


@dataclass(frozen=True)
class NamespaceSettings:
    """Time settings of a namespace."""
    retention: timedelta
    block_size: timedelta
    buffer_past: timedelta
    buffer_future: timedelta

    @classmethod
    def of(cls, retention: Duration, block_size: Duration, buffer_past: Duration,
           buffer_future: Duration) -> NamespaceSettings:
        return cls(*map(as_timedelta, (retention, block_size, buffer_past, buffer_future)))


def admitted(ts: Column, arrival: Column, settings: NamespaceSettings) -> Column:
    """Whether a sample is neither too old nor too far ahead of its arrival."""
    return ((ts >= arrival - interval(settings.buffer_past))
            & (ts <= arrival + interval(settings.buffer_future)))


def admit(points: DataFrame, settings: NamespaceSettings,
          arrival: str = "arrival_ts") -> tuple[DataFrame, DataFrame]:
    """(accepted, refused) points."""
    test = F.coalesce(admitted(F.col("ts"), F.col(arrival), settings), F.lit(False))
    return points.where(test), points.where(~test)


def retained(points: DataFrame, now: Moment, settings: NamespaceSettings) -> DataFrame:
    """Samples inside the retention period; on a stored table old dates are not read."""
    oldest = moment(now) - interval(settings.retention)
    kept = points.where(F.col("ts") >= oldest)
    for cut, column in CUTS.items():
        if column in points.columns:
            kept = kept.where(F.col(column) >= cut_date(oldest, cut))
    return kept


def expired_dates(points: DataFrame, now: Moment, settings: NamespaceSettings) -> DataFrame:
    """The partitions of a stored table that hold nothing but expired samples."""
    column = next((c for c in CUTS.values() if c in points.columns), None)
    if column is None:
        raise ValueError(f"the table is not cut by date: none of {', '.join(CUTS.values())}")
    oldest = F.to_date(moment(now) - interval(settings.retention))
    return points.select(column).where(_last_day(column) < oldest).distinct()


def _last_day(column: str) -> Column:
    """The last day in a partition."""
    return {"block_date": F.col(column), "block_month": F.last_day(column),
            "block_year": F.date_sub(F.add_months(column, 12), 1)}[column]


def drop_expired(spark: SparkSession, path: str, now: Moment,
                 settings: NamespaceSettings) -> list[str]:
    """Delete the partitions of the table at ``path`` that hold nothing but expired samples.

    The partitions are listed by their folder names, so no file is opened.  Samples without
    a time have no date and stay.  Returns the dates dropped, in order.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = {}
    for status in fs.listStatus(root):
        column, _, first = status.getPath().getName().partition("=")
        if column in CUTS.values():
            folders[(column, first)] = status.getPath()
    dropped = []
    for column in sorted({c for c, _ in folders}):
        stored = spark.createDataFrame([(d,) for c, d in folders if c == column], "d string") \
            .select(F.expr("try_cast(d AS date)").alias(column))
        for row in expired_dates(stored, now, settings).collect():
            fs.delete(folders[(column, str(row[0]))], True)
            dropped.append(str(row[0]))
    return sorted(dropped)


def request_stream(spark: SparkSession, path: str, fmt: str = "json",
                   max_files: int | None = None) -> DataFrame:
    """Write requests arriving as files in ``path``."""
    return _files(spark, path, WRITE_REQUEST, fmt, max_files)


def _files(spark: SparkSession, path: str, schema: str, fmt: str,
           max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


# As far as there is input now; {"processingTime": "10 seconds"} goes on for ever.
ALL_THERE_IS = {"availableNow": True}


def ingest(requests: DataFrame, path: str, checkpoint: str, promote: Sequence[str] = (),
           series: str | None = None, trigger: dict = ALL_THERE_IS) -> StreamingQuery:
    """Append a request stream to a points table."""
    return ingest_points(write_request_points(requests), path, checkpoint, promote,
                         series=series, trigger=trigger)


def ingest_messages(messages: DataFrame, path: str, checkpoint: str, promote: Sequence[str] = (),
                    series: str | None = None, trigger: dict = ALL_THERE_IS) -> StreamingQuery:
    """Append a message stream to a points table, unit and annotation kept."""
    return ingest_points(write_message_points(messages), path, checkpoint, promote,
                         ["unit", "annotation"], series, trigger)


def ingest_points(points: DataFrame, path: str, checkpoint: str, promote: Sequence[str] = (),
                  keep: Sequence[str] = (), series: str | None = None,
                  trigger: dict = ALL_THERE_IS) -> StreamingQuery:
    """Append a point stream to a points table, as far as there is input now, or as
    ``trigger`` says.  With ``series``, the series table there is kept complete as well."""
    def write(batch: DataFrame, label: str) -> None:
        if series is not None:
            # first the series: a search in between finds a series without samples at worst
            _append_series(batch, series, label)
        _append(batch, path, label, promote, keep)
    return _batches(points, write, checkpoint, trigger)


def ingest_with_series(points: DataFrame, path: str, series: str, checkpoint: str,
                       promote: Sequence[str] = (), keep: Sequence[str] = (),
                       trigger: dict = ALL_THERE_IS) -> tuple[StreamingQuery, StreamingQuery]:
    """As :func:`ingest_points` with ``series``, for feeds that go on for long.

    The series seen are keyed state of a query of their own, so a batch looks up its own series and
    never reads the series table: its cost does not grow with the table.  Returns (query of the
    series, query of the points); a point may be there a moment before its series.
    """
    found = points.select(*SERIES, "tags").dropDuplicates(SERIES)

    def write(batch: DataFrame, label: str) -> None:
        batch.withColumn("series_id", fnv32a(F.col("series_key"))) \
            .withColumn("batch_id", F.lit(label)).hint("rebalance") \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("batch_id").parquet(series)
    return (_batches(found, write, f"{checkpoint}/series", trigger),
            ingest_points(points, path, f"{checkpoint}/points", promote, keep, trigger=trigger))


def once(points: DataFrame, settings: NamespaceSettings,
         keys: Sequence[str] = (*SERIES, "ts", "value")) -> DataFrame:
    """A feed that may be sent again, each sample once.

    A sample is known by ``keys``.  What was seen is kept as state for ``buffer_past`` behind the
    newest sample; later samples are too late for the namespace and are left out, so a
    message sent again after that brings nothing either.  Samples without a time are left out.
    """
    at = points.where(F.col("ts").isNotNull()) \
        .withColumn("__at", F.timestamp_micros(to_micros(F.col("ts"))))
    return at.withWatermark("__at", window_text(settings.buffer_past)) \
        .dropDuplicatesWithinWatermark(list(keys)).drop("__at")


def _batches(points: DataFrame, write, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Runs ``write(batch, label)``; labels tell batches and feeds apart and are the same
    when a batch is run again."""
    feed = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    return points.writeStream.foreachBatch(lambda batch, n: write(batch, f"{feed}-{n}")) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()


@contextmanager
def _kept(batch: DataFrame) -> Iterator[DataFrame]:
    """A batch that several tables take: computed once.  What a lost executor held is computed
    again from the batch's offsets."""
    kept = batch.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def _append(batch: DataFrame, path: str, label: str, promote: Sequence[str] = (),
            keep: Sequence[str] | None = None) -> None:
    """Adds a batch to a points table: cut by date first, then by batch; even, sorted files.

    Only folders of this label are overwritten, so a batch run again after a failure leaves
    no sample twice.
    """
    if keep is None:
        keep = [c for c in batch.columns if c not in POINT_COLUMNS]
    layout(batch, promote, keep).withColumn("batch_id", F.lit(label)) \
        .hint("rebalance", "block_date").sortWithinPartitions("block_date", "series_key", "ts") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("block_date", "batch_id").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has files; a table that cannot be read is an error, not a missing one."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(root) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(root))


def _append_series(batch: DataFrame, path: str, label: str) -> None:
    """Adds the series of a batch that no other batch has brought yet."""
    spark, found = batch.sparkSession, series_of(batch)
    if _exists(spark, path):
        known = spark.read.parquet(path).where(F.col("batch_id") != label)
        found = found.join(known.select(*SERIES), SERIES, "left_anti")
    found.withColumn("series_id", fnv32a(F.col("series_key"))) \
        .withColumn("batch_id", F.lit(label)).hint("rebalance") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("batch_id").parquet(path)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Writes the table at ``path`` with the many files of its batches merged to ``target``,
    a new table in the layout of :func:`~tidegrid.sinks.points.write_points`."""
    stored = spark.read.parquet(path)
    stored.drop("batch_id").hint("rebalance", "block_date") \
        .sortWithinPartitions("block_date", "series_key", "ts") \
        .write.partitionBy("block_date").parquet(target)


def ingest_admitted(points: DataFrame, settings: NamespaceSettings, accepted: str, refused: str,
                    checkpoint: str, arrival: str = "arrival_ts",
                    trigger: dict = ALL_THERE_IS) -> StreamingQuery:
    """Append admitted points to one table and the refused to another."""
    def write(batch: DataFrame, label: str) -> None:
        with _kept(batch) as rows:
            for part, path in zip(admit(rows, settings, arrival), (accepted, refused)):
                _append(part, path, label)
    return _batches(points, write, checkpoint, trigger)


def fanout_ingest(points: DataFrame, stores: Sequence[Store], checkpoint: str,
                  accept: StoreFilter = local_only,
                  trigger: dict = ALL_THERE_IS) -> StreamingQuery:
    """Append a point stream to every accepted store."""
    chosen = filter_stores(stores, accept)

    def write(batch: DataFrame, label: str) -> None:
        with _kept(batch) as rows:
            for store in chosen:
                _append(rows, store.path, label)
    return _batches(points, write, checkpoint, trigger)


def message_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                   max_files: int | None = None) -> DataFrame:
    """Write messages of the link between sites arriving as files in ``path``."""
    return _files(spark, path, WRITE_MESSAGE, fmt, max_files)


def consolidate_stream(points: DataFrame, settings: NamespaceSettings, fn: str,
                       by: Sequence[str] = ("namespace", "name", "series_key"),
                       arrival: str | None = None,
                       resolutions: dict[str, Duration] | None = None) -> DataFrame:
    """Windowed consolidation of a point stream, one row per closed window.

    Windows are blocks, and namespaces stay apart.  With ``resolutions``, windows are as wide
    as the coarsest of them and ``fn`` runs over one value per namespace listed, as in
    :func:`~tidegrid.operators.grid.consolidate`; ``namespace`` is no key then.

    With ``arrival``, only admitted samples take part; without that test a single sample
    from far ahead moves the watermark and closes every window before it.

    ``buffer_past`` is the watermark delay; a window leaves once no admitted sample can
    reach it any more.  Watermarks need an instant, so ``ts`` is read as UTC here.
    """
    width: Duration = settings.block_size
    value, names = F.col("value"), sorted(resolutions or {})
    if resolutions:
        by = [c for c in by if c != "namespace"]
        width = coarsest(resolutions)
        points = points.where(F.col("namespace").isin(names))
    if arrival is not None:
        points, _ = admit(points, settings, arrival)
    at = points.withColumn("at", F.timestamp_micros(to_micros(F.col("ts"))))
    cells = at.withWatermark("at", window_text(settings.buffer_past)) \
        .groupBy(*by, stream_window(F.col("at"), width).alias("w"))
    start = F.timestamp_add("MICROSECOND", F.unix_micros("w.start"), epoch()).alias("step_ts")
    if not resolutions:
        return cells.agg(fold(fn, value, F.col("at")).alias("value")).select(*by, start, "value")
    return cells.agg(*cell_aggregates(names, fn, value, F.col("at"))) \
        .select(*by, start, cell_value(names, fn).alias("value"))


def append_stream(df: DataFrame, path: str, checkpoint: str,
                  trigger: dict = ALL_THERE_IS) -> StreamingQuery:
    """Append closed windows to a parquet table, as far as there is input now, or as
    ``trigger`` says."""
    return df.writeStream.format("parquet").outputMode("append").option("path", path) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
