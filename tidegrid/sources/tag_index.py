"""Inverted tag index of a series table: posting bitmaps per tag value.

Series are numbered.  For every distinct (tag, value) the index knows the series that have it: as
bitmaps of 32,768 numbers each where they are many, as a short list where they are at most ``RARE``.
Matchers are decided on the distinct values alone, a regular expression is tried once per
value, and series are found by OR, AND and AND NOT of bitmaps.  Four tables under one path:

    series    number, namespace, name, series_key, tags; cut by shard (a range of numbers)
    values    field, tag, value, n, members (series numbers if n <= RARE, else null)
    postings  field, tag, value, bucket, bits; sorted, so that scans skip other tags
    all       bucket, bits of all series

``field`` is ``tag``, or ``name`` for the metric's name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.matchers import Matcher, MatchType
from tidegrid.functions.times import Moment
from tidegrid.operators.fetch import in_range
from tidegrid.sources.points import SERIES

RARE = 32
BUCKET_BITS = 32_768
# A table without rows has no file that tells its columns, so they are told here.
SCHEMAS = {
    "series": "namespace string, name string, series_key string, tags map<string,string>, "
              "number long, shard long",
    "held": "field string, tag string, value string, bucket long, numbers array<long>, n long",
    "values": "field string, tag string, value string, n long, members array<long>",
    "postings": "field string, tag string, value string, bucket long, bits binary",
    "all": "bucket long, bits binary",
}
_POSITIVE = {MatchType.NOT_EQUAL: MatchType.EQUAL, MatchType.NOT_REGEXP: MatchType.REGEXP}


def write_tag_index(series: DataFrame, path: str, mode: str = "error") -> TagIndex:
    """Builds the index of ``series`` (namespace, name, series_key, tags) below ``path``.

    Rows that repeat a series are numbered each for itself: hand over distinct ones.  A null tag
    value is an absent tag.
    """
    spark = series.sparkSession
    # like tags side by side: their series then share few bitmaps
    ordered = series.select(*SERIES, "tags").repartitionByRange("name", "series_key", "namespace") \
        .sortWithinPartitions("name", "series_key", "namespace")
    numbered = ordered.withColumn("number", F.monotonically_increasing_id() + 1)
    # numbers of one partition follow on from each other; a shard is a run of whole buckets
    numbered = numbered.withColumn("shard", _shard())
    numbered.write.mode(mode).partitionBy("shard").parquet(f"{path}/series")
    stored = _read(spark, path, "series")

    bucket = F.bitmap_bucket_number("number").alias("bucket")
    at = F.bitmap_bit_position("number")
    stored.groupBy(bucket).agg(F.bitmap_construct_agg(at).alias("bits")) \
        .write.mode(mode).parquet(f"{path}/all")

    tags = stored.select("number", F.explode("tags").alias("tag", "value")) \
        .where("value is not null").select(F.lit("tag").alias("field"), "tag", "value", "number")
    names = stored.where("name is not null").select(
        F.lit("name").alias("field"), F.lit("").alias("tag"), F.col("name").alias("value"), "number")
    keys = ["field", "tag", "value"]
    # bounded groups first: a value that most series have has one row per bucket from here on
    held = tags.unionByName(names).groupBy(*keys, bucket).agg(
        F.collect_list("number").alias("numbers"), F.count(F.lit(1)).alias("n"))
    held.write.mode(mode).parquet(f"{path}/held")
    held = _read(spark, path, "held")
    totals = held.groupBy(*keys).agg(F.sum("n").alias("n"))
    few = held.join(totals.where(F.col("n") <= RARE).select(*keys), keys, "left_semi") \
        .groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("numbers"))).alias("members"))
    totals.join(few, keys, "left").sortWithinPartitions(*keys) \
        .write.mode(mode).parquet(f"{path}/values")
    many = held.join(totals.where(F.col("n") > RARE).select(*keys), keys, "left_semi") \
        .select(*keys, "bucket", F.explode("numbers").alias("number"))
    many.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(at).alias("bits")) \
        .repartitionByRange(*keys, "bucket").sortWithinPartitions(*keys, "bucket") \
        .write.mode(mode).parquet(f"{path}/postings")
    return TagIndex(spark, path)


def _read(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{path}/{table}")


def _shard() -> Column:
    """A run of 64 whole buckets."""
    return F.shiftright(F.col("number") - 1, 21)


def _combine(signs: list[bool]):
    """Numbers left by AND of the positive and AND NOT of the negative sets of each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f"set{i}").to_pylist() for i in range(len(signs))]
            for row, (bucket, bits) in enumerate(zip(batch.column("bucket").to_pylist(),
                                                     batch.column("bits").to_pylist())):
                left = np.frombuffer(bits, np.uint8)
                for column, positive in zip(columns, signs):
                    own = np.frombuffer(column[row], np.uint8) if column[row] is not None \
                        else np.zeros(len(left), np.uint8)
                    left = left & (own if positive else ~own)
                found = np.flatnonzero(np.unpackbits(left, bitorder="little"))
                # numbers and buckets count from 1
                numbers = found + (bucket - 1) * BUCKET_BITS + 1
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64())], names=["number"])
    return run


class TagIndex:
    """A stored index; see :func:`write_tag_index`."""

    def __init__(self, spark: SparkSession, path: str):
        self.series = _read(spark, path, "series")
        self.values = _read(spark, path, "values")
        self.postings = _read(spark, path, "postings")
        self.all = _read(spark, path, "all")

    def tag_values(self, tag: str, matcher: Matcher | None = None) -> DataFrame:
        """Distinct values of a tag and in how many series each is: (value, n)."""
        kept = self.values.where((F.col("field") == "tag") & (F.col("tag") == tag))
        kept = kept if matcher is None else kept.where(matcher.condition(F.col("value")))
        return kept.select("value", "n")

    def _having(self, field: str, tag: str, test: Column) -> DataFrame:
        """(bucket, bits) of the series with a value that passes ``test``."""
        here = (F.col("field") == field) & (F.col("tag") == tag) & test
        values = self.values.where(here)
        rare = values.where("members is not null").select(F.explode("members").alias("number")) \
            .groupBy(F.bitmap_bucket_number("number").alias("bucket")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        return self.postings.where(here).select("bucket", "bits").unionByName(rare)

    def numbers(self, matchers: Iterable[Matcher], name: str | None = None) -> DataFrame:
        """The numbers of the series that match all; no matchers match every series.

        An absent tag fails ``=`` and ``=~`` and passes ``!=`` and ``!~``.
        """
        sets = []
        for m in matchers:
            positive = Matcher(_POSITIVE.get(m.type, m.type), m.name, m.value)
            sets.append((m.type not in _POSITIVE,
                         self._having("tag", m.name, positive.condition(F.col("value")))))
        if name is not None:
            sets.append((True, self._having("name", "", F.col("value") == name)))
        if not sets:
            return self.series.select("number")
        labelled = None
        for i, (_, rows) in enumerate(sets):
            rows = rows.withColumn("label", F.lit(i))
            labelled = rows if labelled is None else labelled.unionByName(rows)
        found = labelled.groupBy("bucket").agg(*[
            F.bitmap_or_agg(F.when(F.col("label") == i, F.col("bits"))).alias(f"set{i}")
            for i in range(len(sets))])
        # with a positive test, buckets that it does not know cannot hold a match
        how = "inner" if any(sign for sign, _ in sets) else "left"
        return self.all.join(found, "bucket", how) \
            .mapInArrow(_combine([sign for sign, _ in sets]), "number long")

    def search(self, matchers: Iterable[Matcher] = (), name: str | None = None) -> DataFrame:
        """The matching series: (namespace, name, series_key, tags).

        Only rows of shards with a match are read where Spark prunes partitions at run time.
        """
        found = self.numbers(matchers, name).withColumn("shard", _shard())
        return self.series.join(found, ["shard", "number"], "left_semi").select(*SERIES, "tags")

    def fetch(self, points: DataFrame, matchers: Iterable[Matcher], start: Moment, end: Moment,
              name: str | None = None, limit: int | None = None) -> DataFrame:
        """Samples in ``[start, end)`` of the series that match, as ``operators.fetch.fetch``."""
        chosen = self.search(matchers, name).select(*SERIES)
        if limit is not None:
            chosen = chosen.orderBy(*SERIES).limit(limit)
        return in_range(points, start, end).join(chosen, SERIES, "left_semi") \
            .select(*points.columns)
