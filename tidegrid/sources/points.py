"""The points table: long rows of tagged samples, and adapters that make it.

    namespace, name, series_key, tags MAP, ts TIMESTAMP_NTZ, value DOUBLE [, kept columns]

``series_key`` is the canonical tag text.  Rows of one series share (namespace, name,
series_key); every grouping and join goes by these three, so two series whose 32-bit ids
collide stay apart.  The numeric ``series_id`` is derived from ``series_key`` where a
result shows it, after aggregation wherever there is one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.ids import fnv32a, key_text, key_text_of
from tidegrid.functions.values import nan_for_null

SERIES = ["namespace", "name", "series_key"]
DEFAULT_NAMESPACE = "default"


def points_from(df: DataFrame, name: str, tags: dict[str, str | Column], ts: str, value: str,
                namespace: str = DEFAULT_NAMESPACE, keep: Iterable[str] = ()) -> DataFrame:
    """Points from a flat table; ``tags`` maps each tag key to the column holding it.

    The map is built from columns, so Catalyst reduces ``tags['k']`` to the column itself:
    matchers on it are pushed to the scan and unused tags are pruned.
    """
    columns = {k: (F.col(c) if isinstance(c, str) else c).cast("string")
               for k, c in tags.items()}
    pairs = [x for k in sorted(columns) for x in (F.lit(k), columns[k])]
    return df.select(
        F.lit(namespace).alias("namespace"),
        F.lit(name).alias("name"),
        key_text_of(columns).alias("series_key"),
        F.create_map(*pairs).alias("tags"),
        F.col(ts).alias("ts"),
        nan_for_null(F.col(value)).alias("value"),
        *keep)


def points_from_map(df: DataFrame, namespace: str = DEFAULT_NAMESPACE,
                    keep: Iterable[str] = ()) -> DataFrame:
    """Points from rows (name, tags MAP, ts, value)."""
    return df.select(
        F.lit(namespace).alias("namespace"), "name",
        key_text(F.col("tags")).alias("series_key"), "tags", "ts",
        nan_for_null(F.col("value")).alias("value"), *keep)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows; unlike ``distinct`` it takes map columns."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).drop("__n")


def with_series_id(df: DataFrame) -> DataFrame:
    """Add the numeric id of ``series_key``."""
    return df.withColumn("series_id", fnv32a(F.col("series_key")))


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def events_points(spark: SparkSession, sf_dir: str, namespace: str = DEFAULT_NAMESPACE,
                  keep: Iterable[str] = ("event_id",)) -> DataFrame:
    """One series per (event type, user)."""
    return points_from(read_table(spark, sf_dir, "events"), "events",
                       {"event_type": "event_type", "user_id": "user_id"},
                       "ts", "value", namespace, keep)


def lineitem_points(spark: SparkSession, sf_dir: str, namespace: str = DEFAULT_NAMESPACE,
                    keep: Iterable[str] = ("l_orderkey", "l_linenumber")) -> DataFrame:
    """Shipped quantity, one series per (return flag, line status, supplier)."""
    return points_from(read_table(spark, sf_dir, "lineitem"), "lineitem",
                       {"linestatus": "l_linestatus", "returnflag": "l_returnflag",
                        "suppkey": "l_suppkey"},
                       "l_shipdate", "l_quantity", namespace, keep)
