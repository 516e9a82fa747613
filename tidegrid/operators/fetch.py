"""Fetch and search: matchers, time range, limits, explicit ids."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.ids import fnv32a
from tidegrid.functions.matchers import Matcher, MatchType, all_of, from_wire, to_tags
from tidegrid.functions.times import (Duration, Moment, as_timedelta, from_millis, interval,
                                      micros_of, moment, to_micros)
from tidegrid.sources.points import SERIES, distinct_rows

DEFAULT_LIMIT = 1000
# Columns a stored table may be cut by, and the width of a partition.
CUTS = {"day": "block_date", "month": "block_month", "year": "block_year"}
# id lists up to this length become an IN filter, longer ones a join
INLINE_IDS = 1000


def in_range(df: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Samples with ``start <= ts < end``; on a table cut by date the partitions outside
    are left out."""
    start, end = moment(start), moment(end)
    kept = df.where((F.col("ts") >= start) & (F.col("ts") < end))
    for cut, column in CUTS.items():
        if column in df.columns:
            kept = kept.where((F.col(column) >= cut_date(start, cut))
                              & (F.col(column) <= F.to_date(end)))
    return kept


def cut_date(ts: Column, cut: str) -> Column:
    """First day of the partition that holds ``ts``."""
    return F.to_date(ts) if cut == "day" else F.trunc(F.to_date(ts), cut)


def fetch(points: DataFrame, matchers: Iterable[Matcher], start: Moment, end: Moment,
          name: str | None = None, limit: int | None = None,
          series: DataFrame | None = None) -> DataFrame:
    """Samples in ``[start, end)`` of the series that match.

    ``series`` is an optional table of distinct series.  Matching then reads only that
    table and the samples are semi-joined to it: the way to go when ``points`` is a stored
    table whose tags are a real map, on which no scan can filter.  ``limit`` bounds the
    number of series, never of samples.
    """
    matchers = list(matchers)
    window = in_range(points, start, end)
    if series is None and limit is None:
        return matching(window, matchers, name)
    chosen = matching(window if series is None else series, matchers, name).select(*SERIES)
    if limit is not None:
        chosen = chosen.distinct().orderBy(*SERIES).limit(limit)
    return window.join(chosen, SERIES, "left_semi").select(*points.columns)


def matching(df: DataFrame, matchers: Iterable[Matcher], name: str | None = None) -> DataFrame:
    """The rows, samples or series, that match."""
    kept = df.where(all_of(matchers, df.columns))
    return kept.where(F.col("name") == name) if name is not None else kept


def series_of(points: DataFrame) -> DataFrame:
    """The distinct series: (namespace, name, series_key, tags)."""
    return distinct_rows(points, *SERIES, "tags")


def search(points: DataFrame, matchers: Iterable[Matcher] = (), name: str | None = None,
           start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Matching series without samples; with bounds, those that have a sample inside."""
    window = points if start is None else in_range(points, start, end)
    return series_of(matching(window, matchers, name))


def parse_limit(text: str | None) -> int:
    """The limit of a search request; text that is missing or no ASCII whole number gives
    the default.  A negative limit is kept as given, and :func:`limit_series` takes it as 0."""
    if text is None or not re.fullmatch(r"[+-]?[0-9]+", text, re.ASCII):
        return DEFAULT_LIMIT
    return int(text)


def limit_series(series: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The first ``limit`` series in key order."""
    return series.orderBy(*SERIES).limit(max(0, limit))


def metrics(series: DataFrame) -> DataFrame:
    """Search result rows (namespace, id, tags)."""
    return series.select("namespace", fnv32a(F.col("series_key")).cast("string").alias("id"),
                         "tags")


def fetch_ids(points: DataFrame, keys: DataFrame | list[str], start: Moment,
              end: Moment, namespace: str | None = None) -> DataFrame:
    """Samples of the series named by key text: a list, or a DataFrame with ``series_key``.

    ``namespace`` keeps to one of them; None takes a series from all that have it.  A list
    passes through the driver: hand over long ones as a DataFrame.
    """
    window = in_range(points, start, end)
    if namespace is not None:
        window = window.where(F.col("namespace") == namespace)
    if isinstance(keys, list):
        if len(keys) <= INLINE_IDS:
            return window.where(F.col("series_key").isin(keys))
        keys = points.sparkSession.createDataFrame([(k,) for k in keys], "series_key string")
    return window.join(keys.select("series_key"), "series_key", "left_semi") \
        .select(*points.columns)


@dataclass(frozen=True)
class Selector:
    """A named selector: instant when ``range`` is zero, else over a range.

    A forward selector covers ``[now-offset, now-offset+range)``; a lookback selector
    covers the same length up to ``now-offset``.  With range zero both give the samples at
    exactly ``now-offset``.
    """
    name: str | None = None
    matchers: tuple[Matcher, ...] = ()
    range: Duration = "0"
    offset: Duration = "0"
    direction: str = "forward"

    def __str__(self) -> str:
        tests = ",".join(map(str, self.matchers))
        return f"{self.name or ''}{{{tests}}}[{self.range}] offset {self.offset}"

    def apply(self, points: DataFrame, now: Moment) -> DataFrame:
        at = moment(now) - interval(self.offset)
        length = as_timedelta(self.range)
        if not length:
            # an instant is a one-microsecond window: the finest time there is
            start, end = at, at + F.expr("INTERVAL '0.000001' SECOND")
        elif self.direction == "forward":
            start, end = at, at + interval(length)
        elif self.direction == "lookback":
            start, end = at - interval(length), at
        else:
            raise ValueError(f"unknown direction {self.direction!r}")
        return fetch(points, self.matchers, start, end, name=self.name)


@dataclass(frozen=True)
class FetchRequest:
    """One series by its tags, one range, one storage policy."""
    tags: dict[str, str]
    start: Moment
    end: Moment
    policy: str

    @property
    def series_key(self) -> str:
        ordered = sorted(self.tags.items(), key=lambda tag: tag[0].encode())
        return "".join(f"{key}={value}," for key, value in ordered)

    def id(self) -> Column:
        return fnv32a(F.lit(self.series_key)).cast("string")

    def frame(self, spark: SparkSession) -> DataFrame:
        """The request as a row: (id, series_key, range_start, range_end, policy)."""
        return spark.range(1).select(
            self.id().alias("id"), F.lit(self.series_key).alias("series_key"),
            moment(self.start).alias("range_start"), moment(self.end).alias("range_end"),
            F.lit(self.policy).alias("policy"))

    def fetch(self, points: DataFrame) -> DataFrame:
        """The samples asked for.  The tag tests reach the scan; the key test holds off
        series that have these tags and more."""
        tests = [Matcher(MatchType.EQUAL, k, v) for k, v in self.tags.items()]
        return fetch(points, tests, self.start, self.end) \
            .where(F.col("series_key") == self.series_key)


def resolve(matchers: Iterable[Matcher], start: Moment, end: Moment,
            policy: str) -> FetchRequest:
    """The one request that an all-equality matcher list stands for."""
    return FetchRequest(to_tags(matchers), start, end, policy)


def same_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """Requests of ``left`` that ``right`` holds too: equal series, range and policy."""
    columns = ["series_key", "range_start", "range_end", "policy"]
    return left.join(right.select(*columns).distinct(), columns, "left_semi")


def fetch_requests(points: DataFrame, requests: DataFrame) -> DataFrame:
    """Samples for request rows (series_key, range_start, range_end, policy).

    The requests are keyed by series, so this is an equi-join; overlapping requests for
    one series give a sample once per request, as separate requests would.  On a table cut by
    day they are keyed by day too, which leaves out the partitions of other days.  With a
    column ``namespace`` they keep to it.
    """
    spaced = [c for c in ("namespace",) if c in requests.columns]
    wanted = requests.select(*spaced, "series_key", "range_start", "range_end", "policy")
    keys = [*spaced, "series_key"]
    if CUTS["day"] in points.columns:
        wanted = wanted.withColumn(CUTS["day"], F.explode(F.sequence(
            F.to_date("range_start"), F.to_date("range_end"))))
        keys.append(CUTS["day"])
    joined = points.join(wanted, keys)
    return joined.where((F.col("ts") >= F.col("range_start"))
                        & (F.col("ts") < F.col("range_end")))


def fetch_binned(points: DataFrame, requests: DataFrame, width: Duration = "24h",
                 rows_per_key: int = 1_000_000) -> DataFrame:
    """As :func:`fetch_requests`, for many ranges of few series: an interval join over time bins.

    Ranges are cut into the bins of ``width`` that they touch, and samples meet them by series and
    bin, so a hot series is as many keys as it has bins.  A bin with more than ``rows_per_key``
    samples is dealt over salts, and its requests are repeated once a salt; a bin asked for by
    more than ``rows_per_key`` requests has these dealt, and its samples repeated.  Counting is
    done by partial sums, and nothing is left out: overlaps give a sample once per request.
    Ranges that are empty, or that have a null end, ask for nothing.
    """
    spaced = [c for c in ("namespace",) if c in requests.columns]
    keys = [*spaced, "series_key"]
    wanted = requests.select(*keys, "range_start", "range_end", "policy") \
        .where(F.col("range_start") < F.col("range_end"))
    size = micros_of(width)
    last = F.col("range_end") - F.expr("INTERVAL '0.000001' SECOND")
    wanted = wanted.withColumn("__bin", F.explode(F.sequence(
        _bin(F.col("range_start"), size), _bin(last, size))))
    placed = points.withColumn("__bin", _bin(F.col("ts"), size))

    def heavy(rows: DataFrame, out: str) -> DataFrame:
        """Bins with more rows than a key may have, and over how many salts to deal them."""
        counted = rows.groupBy(*keys, "__bin").agg(F.count(F.lit(1)).alias("n"))
        return counted.where(F.col("n") > rows_per_key).select(
            *keys, "__bin", F.ceil(F.col("n") / rows_per_key).cast("int").alias(out))

    hot = heavy(placed, "__many").join(heavy(wanted, "__asked"), [*keys, "__bin"], "full")

    def salted(rows: DataFrame, deal: str, repeat: str, own: str, other: str) -> DataFrame:
        plan = rows.join(hot, [*keys, "__bin"], "left")
        at = F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if "map<" not in kind
                                 and kind != "variant"]), F.coalesce(deal, F.lit(1))).cast("int")
        return plan.withColumn(own, at).withColumn(other, F.explode(F.sequence(
            F.lit(0), F.coalesce(repeat, F.lit(1)) - 1))).drop("__many", "__asked")

    left = salted(placed, "__many", "__asked", "__row", "__request")
    right = salted(wanted, "__asked", "__many", "__request", "__row")
    joined = left.join(right, [*keys, "__bin", "__row", "__request"])
    return joined.where((F.col("ts") >= F.col("range_start"))
                        & (F.col("ts") < F.col("range_end"))) \
        .select(*points.columns, "range_start", "range_end", "policy")


def _bin(ts: Column, size: int) -> Column:
    at = to_micros(ts)
    return F.call_function("div", at - F.pmod(at, F.lit(size)), F.lit(size))


def fetch_read_request(points: DataFrame, matchers: Iterable[tuple[int, str, str]],
                       start_ms: int, end_ms: int) -> DataFrame:
    """A read request as it comes in: wire matchers and epoch-millisecond bounds."""
    return fetch(points, from_wire(matchers), from_millis(F.lit(start_ms)),
                 from_millis(F.lit(end_ms)))


def fetch_many(points: DataFrame,
               queries: Iterable[tuple[str, Iterable[Matcher], Moment, Moment]]) -> DataFrame:
    """Several queries in one pass: each sample once per query it answers, marked by
    ``query``.  All tests run in a single scan."""
    tests = []
    queries = list(queries)
    if queries:
        # the span of all ranges reaches the partitions of a stored table
        points = in_range(points, F.least(*[moment(q[2]) for q in queries])
                          if len(queries) > 1 else queries[0][2],
                          F.greatest(*[moment(q[3]) for q in queries])
                          if len(queries) > 1 else queries[0][3])
    for label, matchers, start, end in queries:
        hit = (all_of(matchers, points.columns)
               & (F.col("ts") >= moment(start)) & (F.col("ts") < moment(end)))
        tests.append((label, hit))
    if not tests:
        return points.where(F.lit(False)).withColumn("query", F.lit(""))
    any_hit = reduce(lambda a, b: a | b, [hit for _, hit in tests])
    hits = F.filter(F.array(*[F.when(hit, F.lit(label)) for label, hit in tests]),
                    lambda q: q.isNotNull())
    return points.where(any_hit).withColumn("query", F.explode(hits))
