"""Nested records in and out: write requests, JSON metric lines, series of the link
between sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.ids import bench_id, key_text, labels_to_tags, tag_entries
from tidegrid.functions.times import from_millis, to_millis
from tidegrid.functions.values import nan_for_null, single_sample
from tidegrid.sources.points import DEFAULT_NAMESPACE

LABELS = "array<struct<name: string, value: string>>"
SAMPLES = "array<struct<value: double, timestamp: bigint>>"
# Schemas are given, never inferred.
WRITE_REQUEST = f"labels {LABELS}, samples {SAMPLES}"
METRIC_LINE = "metric string, timestamp bigint, tags map<string, string>, value double"
WRITE_MESSAGE = ("tags map<string, string>, "
                 "datapoints array<struct<timestamp: bigint, value: float>>, "
                 "unit int, annotation binary")
WIRE_SERIES = ("name string, start_time bigint, values array<float>, "
               "tags map<string, string>, specification string, millis_per_step int")

NAME_LABEL = "__name__"
# Time unit code of ingested samples: milliseconds.
UNIT_MILLIS = 2


def write_request_points(requests: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Write requests (labels[], samples[]) to points, with the time unit.

    Tags are made once per request, before its samples are spread out.
    """
    extra = [c for c in requests.columns if c not in ("labels", "samples")]
    tagged = requests.withColumn("tags", labels_to_tags(F.col("labels"))) \
        .withColumn("series_key", key_text(F.col("tags")))
    return tagged.select("tags", "series_key", *extra, F.inline("samples")).select(
        F.lit(namespace).alias("namespace"),
        F.coalesce(F.col("tags")[NAME_LABEL], F.lit("")).alias("name"),
        "series_key", "tags", from_millis(F.col("timestamp")).alias("ts"),
        nan_for_null(F.col("value")).alias("value"),
        F.lit(UNIT_MILLIS).alias("unit"), *extra)


def write_message_points(messages: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Write messages of the link between sites to points.  Unit and annotation are carried
    along; values have come through 32 bits."""
    keyed = messages.withColumn("series_key", key_text(F.col("tags")))
    return keyed.select("tags", "series_key", "unit", "annotation", F.inline("datapoints")).select(
        F.lit(namespace).alias("namespace"),
        F.coalesce(F.col("tags")[NAME_LABEL], F.lit("")).alias("name"),
        "series_key", "tags", from_millis(F.col("timestamp")).alias("ts"),
        nan_for_null(F.col("value")).alias("value"), "unit", "annotation")


def write_messages(queries: DataFrame) -> DataFrame:
    """Write queries (tags, datapoints ARRAY<STRUCT<ts, value>>, unit, annotation) to
    messages of the link."""
    return queries.select(
        "tags",
        F.transform("datapoints", lambda p: F.struct(
            to_millis(p["ts"]).alias("timestamp"), p["value"].cast("float").alias("value")))
        .alias("datapoints"), "unit", "annotation")


def read_metric_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON metric per line.  Blank lines are skipped; a malformed line is fatal."""
    return spark.read.schema(METRIC_LINE).option("mode", "FAILFAST").json(path)


def parse_metric(text: Column) -> Column:
    """One JSON metric text to a struct; malformed text is fatal."""
    return F.from_json(text, METRIC_LINE, {"mode": "FAILFAST"})


def metric_ids(metrics: DataFrame) -> DataFrame:
    """Loader records: (bench_id, ts, value)."""
    return metrics.select(bench_id(F.col("metric"), F.col("tags")).alias("bench_id"),
                          from_millis(F.col("timestamp")).alias("ts"), "value")


def metric_requests(metrics: DataFrame) -> DataFrame:
    """One write request with one sample per metric line.  The metric name is no label."""
    labels = F.transform(tag_entries(F.col("tags")),
                         lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
    extra = [c for c in metrics.columns if c not in ("metric", "timestamp", "tags", "value")]
    return metrics.select(labels.alias("labels"),
                          single_sample(F.col("value"), F.col("timestamp")).alias("samples"),
                          *extra)


def metric_points(metrics: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Points of metric lines, the name kept in ``name``."""
    return metrics.select(
        F.lit(namespace).alias("namespace"), F.col("metric").alias("name"),
        key_text(F.col("tags")).alias("series_key"), "tags",
        from_millis(F.col("timestamp")).alias("ts"),
        nan_for_null(F.col("value")).alias("value"))


def series_to_points(series: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Link series to points: value i lies at start + i * millis_per_step."""
    at = from_millis(F.col("start_time") + F.col("pos") * F.col("millis_per_step"))
    return series.select("name", "tags", "start_time", "millis_per_step",
                         F.posexplode("values").alias("pos", "v")).select(
        F.lit(namespace).alias("namespace"), "name",
        key_text(F.col("tags")).alias("series_key"), "tags", at.alias("ts"),
        F.col("v").cast("double").alias("value"))


def series_to_wire(series: DataFrame, specification: str = "") -> DataFrame:
    """Series arrays (name, start_time, millis_per_step, values, tags) to link records."""
    return series.select(
        "name", to_millis(F.col("start_time")).alias("start_time"),
        F.col("values").cast("array<float>").alias("values"), "tags",
        F.lit(specification).alias("specification"),
        F.col("millis_per_step").cast("int").alias("millis_per_step"))

