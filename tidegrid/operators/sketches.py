"""Mergeable sketches per series, block and namespace: quantiles (KLL) and distinct series (HLL).

A sketch of a block is state: it is stored once and merged upward, to longer blocks, to groups of
series, to all namespaces, without going back to the samples.  Both have partial forms, so a hot
series or block reaches the shuffle as one sketch per task, of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.times import Duration, tumbling
from tidegrid.sources.points import SERIES

# Values kept per level of a quantile sketch; ranks are off by RANK_ERROR or less in 99 of 100 cases.
KLL_SIZE = 400
RANK_ERROR = 0.0070
# Bits of a distinct sketch: 2^LOG_SIZE cells; counts are off by COUNT_ERROR or less in 95 of 100 cases.
LOG_SIZE = 14
COUNT_ERROR = 2 * 0.79 / 2 ** (LOG_SIZE / 2)


def quantile_state(points: DataFrame, block: Duration = "24h", by: Sequence[str] = SERIES,
                   size: int = KLL_SIZE) -> DataFrame:
    """A quantile sketch per ``by`` and block: (by, block_ts, n, missing, sketch).

    NaN has no rank and is counted as ``missing``; a block of NaN alone has a null sketch.
    """
    real = F.when(~F.isnan("value"), F.col("value"))
    cut = points.withColumn("block_ts", tumbling(F.col("ts"), block).start)
    return cut.groupBy(*by, "block_ts").agg(
        F.count(real).alias("n"), F.count_if(F.isnan("value")).alias("missing"),
        F.kll_sketch_agg_double(real, F.lit(size)).alias("sketch")) \
        .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def merge_quantiles(state: DataFrame, by: Sequence[str] = (), block: Duration | None = None) -> DataFrame:
    """State of coarser groups: ``by`` columns and, with ``block``, longer blocks."""
    keys = list(by)
    if block is not None:
        state = state.withColumn("block_ts", tumbling(F.col("block_ts"), block).start)
        keys.append("block_ts")
    return state.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"),
        F.kll_merge_agg_double("sketch").alias("sketch")) \
        .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def sketch_quantile(state: DataFrame, q: float, out: str = "value") -> DataFrame:
    """``state`` with its ``q`` quantile, a value of the samples whose rank is near ``q``."""
    if not 0 <= q <= 1:
        edge = float("-inf") if q < 0 else float("inf")
        return state.withColumn(out, F.lit(edge))
    value = F.when(F.col("sketch").isNotNull(),
                   F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))
    return state.withColumn(out, value)


def sketch_rank(state: DataFrame, value: float, out: str = "rank") -> DataFrame:
    """``state`` with the share of samples at or below ``value``."""
    rank = F.when(F.col("sketch").isNotNull(),
                  F.kll_sketch_get_rank_double("sketch", F.lit(float(value))))
    return state.withColumn(out, rank)


def series_state(points: DataFrame, block: Duration = "24h",
                 by: Sequence[str] = ("namespace", "name")) -> DataFrame:
    """A distinct sketch of the series per ``by`` and block: (by, block_ts, sketch)."""
    cut = points.withColumn("block_ts", tumbling(F.col("ts"), block).start)
    return cut.groupBy(*by, "block_ts").agg(
        F.hll_sketch_agg("series_key", F.lit(LOG_SIZE)).alias("sketch"))


def merge_series(state: DataFrame, by: Sequence[str] = (), block: Duration | None = None) -> DataFrame:
    """The union of sketches: coarser groups and, with ``block``, longer blocks."""
    keys = list(by)
    if block is not None:
        state = state.withColumn("block_ts", tumbling(F.col("block_ts"), block).start)
        keys.append("block_ts")
    return state.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def series_estimate(state: DataFrame, out: str = "n_series") -> DataFrame:
    """``state`` with the estimated number of distinct series."""
    return state.withColumn(out, F.hll_sketch_estimate("sketch"))
