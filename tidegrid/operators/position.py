"""Running position of rows inside a key, without one task per long key.

``row_number`` over a key is a single task.  So keys are cut by an order-preserving bucket:
rows are counted per (key, bucket), the counts are summed up along the buckets (one row per
bucket), and each (key, bucket) is numbered on its own, starting from the sum before it.  This
is one lazy plan, the same for tables of every size.

Where single buckets are known to be very long, a caller asks for ``slices``: pieces of the
whole order, balanced by Spark's range partitioner, take the place of the buckets.  Both number
rows by one full order, so both give the same positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import durable

# Copies of one row are spread out again in runs of this length.
COPY_RUN = 1_000_000

_BUCKET, _FIRST, _WEIGHT, _TOTAL = "__bucket", "__first", "__weight", "__total"


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                  out: str = "position", weight: str | None = None,
                  total_out: str | None = None, slices: int | None = None,
                  whole: bool = False) -> DataFrame:
    """Add ``out``: the weight (rows, by default) before each row of its key in ``order``.

    ``bucket`` must never fall while ``order`` rises, and be null where the first order column
    is.  Rows that ``order`` leaves equal follow by their other columns (maps apart); rows equal
    in these too are copies of each other.  ``total_out`` adds the whole weight of the key.
    Null keys form one key, as in ``groupBy``.  Nothing runs at call time, unless ``slices``
    asks for that many balanced slices, which are written once.  ``whole`` numbers each key in one
    window: for a table bucketed by the keys, whose tasks hold whole keys anyhow, it needs no
    shuffle.
    """
    rows = df.withColumn(_WEIGHT, F.col(weight).cast("bigint") if weight
                         else F.lit(1).cast("bigint"))
    if whole:
        along = Window.partitionBy(*keys)
        before = along.orderBy(*_full(rows, keys, order)) \
            .rowsBetween(Window.unboundedPreceding, -1)
        numbered = rows.withColumn(out, F.coalesce(F.sum(_WEIGHT).over(before), F.lit(0)))
        if total_out:
            numbered = numbered.withColumn(total_out, F.sum(_WEIGHT).over(along))
    elif slices:
        numbered = _number_sliced(rows, keys, order, out, total_out, slices)
    else:
        cut = rows.withColumn(_BUCKET, bucket)
        numbered = _number(cut, _totals(cut, keys), keys, _full(rows, keys, order), out, total_out)
    return numbered.select(*df.columns, out, *([total_out] if total_out else []))


def _full(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """The order, ended by all columns that can be ordered: rows that are equal in ``order``
    part ways by what they hold, not by when they came."""
    return [*order, *[f.name for f in rows.schema.fields
                      if f.name not in {*keys, *order, _WEIGHT, "__copies", _BUCKET}
                      and _orderable(f.dataType)]]


def _orderable(kind) -> bool:
    return not any(x in kind.simpleString() for x in ("map<", "variant"))


def _totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, _BUCKET).agg(
        F.sum(_WEIGHT).alias(_TOTAL))


def _number(rows: DataFrame, totals: DataFrame, keys: Sequence[str], order: Sequence[str],
            out: str, total_out: str | None) -> DataFrame:
    along = Window.partitionBy(*keys)
    before = along.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, _BUCKET,
        F.coalesce(F.sum(_TOTAL).over(before), F.lit(0)).alias(_WEIGHT),
        F.sum(_TOTAL).over(along).alias("__whole"),
        F.lit(0).alias(_FIRST))
    # the offset enters its bucket as a first row of that weight: one shuffle, no join
    both = rows.withColumn(_FIRST, F.lit(1)).unionByName(offsets, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(_FIRST, *order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = both.withColumn(out, F.sum(_WEIGHT).over(upto))
    if total_out:
        numbered = numbered.withColumn(
            total_out, F.first("__whole").over(
                inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.where(F.col(_FIRST) == 1)


def _number_sliced(rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                   total_out: str | None, slices: int) -> DataFrame:
    # equal rows cannot be told apart by any order, so they travel as one row and a count
    packed = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__copies"))
    full = _full(packed, keys, order)
    sliced = durable(packed.repartitionByRange(slices, *keys, *full)
                     .withColumn(_BUCKET, F.spark_partition_id())
                     .withColumn("__each", F.col(_WEIGHT))
                     .withColumn(_WEIGHT, F.col("__each") * F.col("__copies")))
    numbered = _number(sliced, _totals(sliced, keys), keys, full, out, total_out)
    runs = numbered.withColumn("__run", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("__copies") - 1, F.lit(COPY_RUN).cast("bigint"))))
    runs = runs.repartition(*keys, out, "__run")
    spread = runs.withColumn("__i", F.explode(F.sequence(
        F.col("__run"), F.least(F.col("__run") + COPY_RUN, F.col("__copies")) - 1)))
    return spread.withColumn(out, F.col(out) + F.col("__i") * F.col("__each"))
