"""Several stores behind one fetch: filters, union, remote precision."""

from __future__ import annotations

import enum
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.matchers import Matcher
from tidegrid.functions.times import Moment
from tidegrid.functions.values import wire_precision
from tidegrid.operators.fetch import fetch, limit_series, matching, search
from tidegrid.sources.points import SERIES
from tidegrid.sources.wire import WIRE_SERIES, series_to_points


class StoreType(enum.Enum):
    LOCAL = "local"
    REMOTE = "remote"
    MULTI = "multi"


@dataclass(frozen=True)
class Query:
    """What a store is asked for; ``limit`` bounds the series that each store gives."""
    matchers: tuple[Matcher, ...]
    start: Moment
    end: Moment
    name: str | None = None
    limit: int | None = None


@dataclass(frozen=True)
class Store:
    """A named points table; ``series`` optionally holds its distinct series.

    ``series``, if given, answers searches and is taken as current for any range.
    ``lossy`` gives values the 32-bit precision of the link between sites.
    ``path`` is where writes to the store go.
    """
    label: str
    type: StoreType
    points: DataFrame | None = None
    series: DataFrame | None = None
    lossy: bool = False
    path: str | None = None

    def fetch(self, query: Query) -> DataFrame:
        found = fetch(self.points, query.matchers, query.start, query.end, name=query.name,
                      limit=query.limit, series=self.series)
        return found.withColumn("value", wire_precision(F.col("value"))) if self.lossy else found

    def search(self, query: Query) -> DataFrame:
        if self.series is not None:
            known = matching(self.series, query.matchers, query.name).select(*SERIES, "tags")
        else:
            known = search(self.points, query.matchers, query.name, query.start, query.end)
        return known if query.limit is None else limit_series(known, query.limit)


StoreFilter = Callable[[Query | None, Store], bool]


def local_only(query: Query | None, store: Store) -> bool:
    return store.type is StoreType.LOCAL


def allow_all(query: Query | None, store: Store) -> bool:
    return True


def allow_none(query: Query | None, store: Store) -> bool:
    return False


def filter_stores(stores: Iterable[Store], accept: StoreFilter,
                  query: Query | None = None) -> list[Store]:
    """The accepted stores, in order.  The others are never read."""
    return [s for s in stores if accept(query, s)]


def _marked(df: DataFrame, store: Store) -> DataFrame:
    return df.withColumn("store", F.lit(store.label)) \
        .withColumn("store_type", F.lit(store.type.value))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def fanout_fetch(stores: Sequence[Store], query: Query,
                 accept: StoreFilter = local_only) -> DataFrame:
    """The fetch of every accepted store, one after another, duplicates kept, with
    ``store`` and ``store_type``.  No accepted store gives an empty result, and so do no
    stores at all."""
    chosen = filter_stores(stores, accept, query)
    if not chosen:
        return _nothing(_FOUND + ", ts timestamp_ntz, value double")
    return _union([_marked(_plain(s.fetch(query)), s) for s in chosen])


_FOUND = "namespace string, name string, series_key string, tags map<string,string>"


def _nothing(columns: str) -> DataFrame:
    return SparkSession.active().createDataFrame(
        [], columns + ", store string, store_type string")


def _plain(points: DataFrame) -> DataFrame:
    return points.select("namespace", "name", "series_key", "tags", "ts", "value")


def fanout_search(stores: Sequence[Store], query: Query,
                  accept: StoreFilter = local_only) -> DataFrame:
    """The tag search of every accepted store; a series in two stores is listed twice."""
    chosen = filter_stores(stores, accept, query)
    if not chosen:
        return _nothing(_FOUND)
    return _union([_marked(s.search(query), s) for s in chosen])


def all_local() -> Column:
    """Aggregate: true when no other than local stores took part; true for no rows."""
    return F.coalesce(F.every(F.col("store_type") == "local"), F.lit(True))


def only_local(result: DataFrame) -> DataFrame:
    """One row with :func:`all_local`."""
    return result.agg(all_local().alias("local_only"))


def append_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Pages of one remote answer, one after another; no pages give no points."""
    if not pages:
        return SparkSession.active().createDataFrame(
            [], _FOUND + ", ts timestamp_ntz, value double")
    return _union(pages)


def remote_points(spark: SparkSession, path: str) -> DataFrame:
    """Points from records of the link: name, start_time (ms), values ARRAY<FLOAT>, tags,
    specification, millis_per_step."""
    return series_to_points(spark.read.schema(WIRE_SERIES).parquet(path))
