"""Time blocks: cutting, indexing, alignment, regrouping by time, common tags."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.ids import tag_entries
from tidegrid.functions.matchers import Matcher
from tidegrid.functions.times import Duration, Moment, tumbling
from tidegrid.operators.fetch import fetch
from tidegrid.sources.points import SERIES, distinct_rows


MISALIGNED = "blocks of equal index differ in their bounds"


def with_block(points: DataFrame, size: Duration) -> DataFrame:
    """Add ``block_start`` and ``block_end``."""
    block = tumbling(F.col("ts"), size)
    return points.withColumn("__b", block).select(
        *points.columns, F.col("__b.start").alias("block_start"),
        F.col("__b.end").alias("block_end"))


def fetch_blocks(points: DataFrame, matchers: Iterable[Matcher], start: Moment, end: Moment,
                 size: Duration) -> DataFrame:
    """A fetch whose samples carry the bounds of their block."""
    return with_block(fetch(points, matchers, start, end), size)


def series_blocks(points: DataFrame, size: Duration) -> DataFrame:
    """One record per (series, namespace, block), numbered per series and namespace:
    block_start, block_end, block_idx, n_points, value_sum.

    A hot series is counted before the shuffle; the numbering sees one row per block.
    """
    records = with_block(points, size).groupBy(*SERIES, "block_start", "block_end").agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("value").alias("value_sum"))
    return index_blocks(records)


def index_blocks(records: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Number block records by start time, from 0, within ``keys``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("block_start", "block_end"))
    return records.withColumn("block_idx", (place - 1).cast("int"))


def misaligned_blocks(blocks: DataFrame, by: Sequence[str] = (),
                      member: str = "series_key") -> DataFrame:
    """Block indexes (per ``by``) whose bounds differ between members, or which the first
    member, in ``member`` order, does not have."""
    spans = blocks.groupBy(*by, "block_idx").agg(
        F.min("block_start").alias("min_start"), F.max("block_start").alias("max_start"),
        F.min("block_end").alias("min_end"), F.max("block_end").alias("max_end"),
        F.min(member).alias("__first"))
    # one row per index is left, so this window is short
    overall = F.min("__first").over(Window.partitionBy(*by))
    flagged = spans.withColumn("missing_in_first", F.col("__first") != overall)
    return flagged.where(
        (F.col("min_start") != F.col("max_start")) | (F.col("min_end") != F.col("max_end"))
        | F.col("missing_in_first")).drop("__first")


def _uneven(first: Column, overall: Column) -> Column:
    return (F.col("block_start") != F.col("max_start")) | (F.col("block_end") != F.col("max_end")) \
        | (first != overall)


def _or_raise(fault: Column) -> Column:
    """A filter that keeps every row and fails the job at a fault."""
    return F.when(fault, F.raise_error(F.lit(MISALIGNED)).cast("boolean")).otherwise(F.lit(True))


def merge_namespaces(blocks: DataFrame, strict: bool = True) -> DataFrame:
    """Block i of every namespace of a series as one record; ``parts`` lists the
    namespaces in order.  Its length is the number of namespaces, never of samples.

    Blocks of equal index must have equal bounds and be there in the first namespace; the job
    fails where they are not.  Without ``strict``, ``misaligned`` marks such records, whose
    bounds are the earliest of each.
    """
    part = F.struct("namespace", "n_points", "value_sum")
    merged = blocks.groupBy("name", "series_key", "block_idx").agg(
        F.min("block_start").alias("block_start"), F.min("block_end").alias("block_end"),
        F.array_sort(F.collect_list(part)).alias("parts"),
        F.max("block_start").alias("max_start"), F.max("block_end").alias("max_end"))
    # the first namespace of each record leads its parts; one row per index is left here
    overall = F.min(F.col("parts")[0]["namespace"]).over(Window.partitionBy("name", "series_key"))
    merged = merged.withColumn("misaligned", _uneven(F.col("parts")[0]["namespace"], overall)) \
        .drop("max_start", "max_end")
    return merged.where(_or_raise(F.col("misaligned"))).drop("misaligned") if strict else merged


def by_time(blocks: DataFrame, strict: bool = True) -> DataFrame:
    """Series-major records to time-major rows: (block_idx, block_start, block_end), then
    the records of all series under these bounds, as rows clustered by block.

    A block is no single group: its rows are spread, so that one with very many series
    does not end in one task.  With ``strict`` the job fails at blocks of equal index with
    different bounds, or that the first series does not have.
    """
    if strict:
        bounds = blocks.groupBy("block_idx").agg(
            F.min("block_start").alias("block_start"), F.max("block_start").alias("max_start"),
            F.min("block_end").alias("block_end"), F.max("block_end").alias("max_end"),
            F.min("series_key").alias("__first"))
        overall = F.min("__first").over(Window.partitionBy())  # one row for each index
        checked = bounds.withColumn("__all", overall) \
            .where(_or_raise(_uneven(F.col("__first"), F.col("__all"))))
        blocks = blocks.join(checked.select("block_idx"), "block_idx", "left_semi") \
            .select(*blocks.columns)
    lead = ["block_idx", "block_start", "block_end"]
    rest = [c for c in blocks.columns if c not in lead]
    return blocks.select(*lead, *rest).hint("rebalance", "block_start") \
        .sortWithinPartitions("block_start", *[k for k in SERIES if k in rest])


def block_summary(blocks: DataFrame) -> DataFrame:
    """Per time bound: number of series records, samples, and their sum."""
    return blocks.groupBy("block_start", "block_end").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("n_points").alias("n_points"),
        F.sum("value_sum").alias("value_sum"))


def common_tags(points: DataFrame, size: Duration) -> DataFrame:
    """Per block, the tags that all its series share: (block_start, tag, tag_value, n_series).

    A tag is shared when as many series have it as the block has, all with one value: counts,
    smallest and largest values are summed up by (block, tag), never by value.
    """
    members = distinct_rows(with_block(points, size), *SERIES, "tags", "block_start")
    # an empty entry per series counts the series along with the tags
    entries = F.array_union(
        F.transform(tag_entries(F.col("tags")),
                    lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))),
        F.array(F.struct(F.lit(None).cast("string").alias("key"),
                         F.lit(None).cast("string").alias("value"))))
    seen = members.select("block_start", F.explode(entries).alias("e")) \
        .groupBy("block_start", "e.key").agg(
            F.count(F.lit(1)).alias("n"), F.min("e.value").alias("low"),
            F.max("e.value").alias("high"))
    # one row for each tag of a block is left, so this window is short
    n_series = F.max(F.when(F.col("key").isNull(), F.col("n"))).over(
        Window.partitionBy("block_start"))
    return seen.withColumn("n_series", n_series) \
        .where(F.col("key").isNotNull() & (F.col("n") == F.col("n_series"))
               & (F.col("low") == F.col("high"))) \
        .select("block_start", F.col("key").alias("tag"), F.col("low").alias("tag_value"),
                "n_series")


def steps(grid: DataFrame) -> DataFrame:
    """One row per step: how many series have a value there, and the sum over them."""
    return grid.groupBy("step_ts").agg(F.count("value").alias("n_values"),
                                       F.sum("value").alias("value_sum"))


def series_lengths(points: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per series: its number of samples."""
    return points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_points"))
