"""Value arrays and NaN rules: a missing sample is NaN, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def nan_for_null(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(NAN))


def is_missing(value: Column) -> Column:
    return F.isnan(value)


def constant_values(value: Column | float, count: Column | int) -> Column:
    """An array of ``count`` equal values."""
    value = value if isinstance(value, Column) else F.lit(float(value))
    count = count if isinstance(count, Column) else F.lit(count)
    return F.array_repeat(value, count)


def value_at(values: Column, n: Column | int) -> Column:
    """0-based lookup; null outside the array."""
    return F.get(values, n if isinstance(n, Column) else F.lit(n))


def slice_values(values: Column, begin: int, end: int) -> Column:
    """Cells ``[begin, end)``."""
    if not 0 <= begin <= end:
        raise ValueError("need 0 <= begin <= end")
    return F.slice(values, begin + 1, end - begin)


def all_missing(values: Column) -> Column:
    """True when every element is NaN; true for an empty array."""
    return F.forall(values, lambda v: F.isnan(v))


def wire_precision(value: Column) -> Column:
    """The value after a trip through a 32-bit float."""
    return value.cast("float").cast("double")


def single_sample(value: Column, millis: Column) -> Column:
    """A one-element samples list."""
    return F.array(F.struct(value.alias("value"), millis.alias("timestamp")))
