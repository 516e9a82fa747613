"""Matching of two vectors: arithmetic, comparison, set operations.

A vector has one row per series and step: (name, series_key, tags, step_ts, value).  Two
rows match when they agree on the match key - the ``on`` tags, or all tags but the
``ignoring`` ones, or all tags - and on ``step_ts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.ids import key_text, key_text_of
from tidegrid.functions.matchers import tag_column

# How many ways the rows of one match key are spread on the side that may have many; a
# power of two.
SPREAD = 8

ARITHMETIC = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    # IEEE division, remainder and power: by zero gives infinity or NaN, never an error
    "/": lambda a, b: F.when(b != 0, a / F.nullif(b, F.lit(0.0))).otherwise(a * F.pow(b, F.lit(-1))),
    "%": lambda a, b: F.when(b != 0, a % F.nullif(b, F.lit(0.0))).otherwise(
        F.lit(float("nan"))),
    "^": F.pow,
}

# NaN equals nothing and is in no order with anything, unlike in Spark's own comparison.
COMPARISONS = {
    "==": lambda a, b: (a == b) & ~_any_nan(a, b),
    "!=": lambda a, b: (a != b) | _any_nan(a, b),
    "<": lambda a, b: (a < b) & ~_any_nan(a, b),
    "<=": lambda a, b: (a <= b) & ~_any_nan(a, b),
    ">": lambda a, b: (a > b) & ~_any_nan(a, b),
    ">=": lambda a, b: (a >= b) & ~_any_nan(a, b),
}


def _any_nan(a: Column, b: Column) -> Column:
    return F.isnan(a) | F.isnan(b)


def vector(df: DataFrame, tags: Sequence[str], value: str = "value",
           name: str = "") -> DataFrame:
    """A vector from an aggregate: its grouping columns become the tags."""
    columns = {t: F.col(f"`{t}`").cast("string") for t in tags}
    pairs = [x for t in sorted(columns) for x in (F.lit(t), columns[t])]
    as_map = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")
    return df.select(F.lit(name).alias("name"), key_text_of(columns).alias("series_key"),
                     as_map.alias("tags"), "step_ts", F.col(value).alias("value"))


def match_columns(df: DataFrame, on: Sequence[str] | None,
                  ignoring: Sequence[str] | None) -> dict[str, Column]:
    """The columns two rows must agree on: the ``on`` tags (absent equals empty), or the
    text of the remaining tags."""
    if on is not None and ignoring is not None:
        raise ValueError("give on or ignoring, not both")
    if on is not None:
        return {f"__on_{t}": F.coalesce(tag_column(t, df.columns), F.lit(""))
                for t in sorted(on)}
    return {"__rest": key_text(_remaining(ignoring)) if ignoring else F.col("series_key")}


def _remaining(ignoring: Sequence[str]) -> Column:
    dropped = list(ignoring)
    return F.map_filter("tags", lambda k, v: ~k.isin(dropped))


def _matched_tags(on: Sequence[str] | None) -> list[Column]:
    """(series_key, tags) of a result that keeps the matched tags only."""
    if on is None:
        return [F.col("__rest").alias("series_key"), F.col("tags")]
    columns = {t: F.nullif(F.col(f"`__on_{t}`"), F.lit("")) for t in sorted(on)}
    pairs = [x for t, c in columns.items() for x in (F.lit(t), c)]
    as_map = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")
    return [key_text_of(columns).alias("series_key"), as_map.alias("tags")]


def _single(df: DataFrame, side: str, on: Sequence[str] | None,
            ignoring: Sequence[str] | None, tags: Column | None = None) -> DataFrame:
    """One row per match key and step; a second one is an error, raised by a filter that no
    pruning of columns takes away.  Counting before the join keeps a key with many rows on
    both sides from multiplying."""
    match = match_columns(df, on, ignoring)
    carried = [F.first("__tags").alias("tags")] if tags is not None else []
    if side == "left":
        carried.append(F.first("name").alias("name"))
    rows = df.select("step_ts", "value", *[c.alias(n) for n, c in match.items()],
                     *([tags.alias("__tags")] if tags is not None else []),
                     *(["name"] if side == "left" else [])) \
        .groupBy(*match, "step_ts").agg(
            F.max("value").alias("__max"), F.count(F.lit(1)).alias("__n"), *carried)
    message = F.concat_ws(" ", F.lit(f"more than one series on the {side} side for"),
                          *[F.col(f"`{n}`") for n in match])
    alone = F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return rows.where(alone).select(
        *[f"`{n}`" for n in match], "step_ts", F.col("__max").alias(f"{side}_value"),
        *(["tags"] if tags is not None else []), *(["name"] if side == "left" else []))


def _with_match(df: DataFrame, on, ignoring) -> tuple[DataFrame, list[str]]:
    match = match_columns(df, on, ignoring)
    return df.select("*", *[c.alias(n) for n, c in match.items()]), list(match)


def _spread_join(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str,
                 spread: int) -> DataFrame:
    """Join where ``one`` has a row per (key, step) and ``many`` any number: the many rows
    of a key are spread over ``spread`` tasks and the one row goes to each of them.

    Merged, never broadcast: Spark's size estimate is that of the files, knows neither the
    copies nor the rows of the aggregate, and would send all of them through the driver."""
    if spread & (spread - 1) or spread < 1:
        raise ValueError("the spread must be a power of two")
    if spread == 1:
        return many.join(one.hint("merge"), [*keys, "step_ts"], how)
    # not nullable, so no null test on it wanders down to the scan, where it would keep two
    # uses of one vector from sharing their shuffle
    salt = F.xxhash64("series_key").bitwiseAND(F.lit(spread - 1))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint")))
    return many.withColumn("__salt", salt).join(
        one.withColumn("__salt", copies).hint("merge"),
        [*keys, "step_ts", "__salt"], how).drop("__salt")


def _combined(op: str, a: Column, b: Column, bool_result: bool) -> tuple[Column, Column | None]:
    """Result value and, for a filtering comparison, its condition."""
    if op in ARITHMETIC:
        if bool_result:
            raise ValueError("bool goes with comparisons only")
        return ARITHMETIC[op](a, b), None
    if op not in COMPARISONS:
        raise ValueError(f"unknown operator {op!r}")
    test = COMPARISONS[op](a, b)
    return (test.cast("double"), None) if bool_result else (a, test)


def _finish(joined: DataFrame, op: str, a: Column, b: Column, bool_result: bool,
            *columns) -> DataFrame:
    """The result; a metric's name stays only where a comparison filters its own values."""
    value, keep = _combined(op, a, b, bool_result)
    kept = joined.where(keep) if keep is not None else joined
    name = F.col("name") if keep is not None else F.lit("").alias("name")
    return kept.select(name, *columns, "step_ts", value.alias("value"))


def one_to_one(left: DataFrame, right: DataFrame, op: str, on: Sequence[str] | None = None,
               ignoring: Sequence[str] | None = None, bool_result: bool = False) -> DataFrame:
    """``left op right`` for rows that match one to one; the result is a vector with the
    matched tags.  Both sides come out of their counting already clustered by the key."""
    tags = None if on is not None else _remaining(ignoring) if ignoring else F.col("tags")
    a = _single(left, "left", on, ignoring, tags)
    b = _single(right, "right", on, ignoring)
    joined = a.join(b, [*match_columns(left, on, ignoring), "step_ts"])
    return _finish(joined, op, F.col("left_value"), F.col("right_value"), bool_result,
                   *_matched_tags(on))


def group_left(left: DataFrame, right: DataFrame, op: str, on: Sequence[str] | None = None,
               ignoring: Sequence[str] | None = None, include: Sequence[str] = (),
               bool_result: bool = False, spread: int = SPREAD) -> DataFrame:
    """Many left rows to one right row.  The result keeps the left tags; ``include``
    takes these tags from the right side."""
    return _many_to_one(left, right, op, on, ignoring, include, bool_result, "right", spread)


def group_right(left: DataFrame, right: DataFrame, op: str, on: Sequence[str] | None = None,
                ignoring: Sequence[str] | None = None, include: Sequence[str] = (),
                bool_result: bool = False, spread: int = SPREAD) -> DataFrame:
    """One left row to many right rows."""
    return _many_to_one(right, left, op, on, ignoring, include, bool_result, "left", spread)


def _many_to_one(many: DataFrame, one: DataFrame, op: str, on, ignoring,
                 include: Sequence[str], bool_result: bool, one_side: str,
                 spread: int) -> DataFrame:
    single = _single(one, one_side, on, ignoring, F.col("tags") if include else None)
    single = single.drop("name")
    if include:
        single = single.withColumnRenamed("tags", "one_tags")
    keyed, keys = _with_match(many, on, ignoring)
    joined = _spread_join(keyed, single, keys, "inner", spread)
    own, other = F.col("value"), F.col(f"{one_side}_value")
    a, b = (own, other) if one_side == "right" else (other, own)
    tags, key = F.col("tags"), F.col("series_key")
    if include:
        taken = list(include)
        entries = F.concat(
            F.filter(F.map_entries("tags"), lambda e: ~e["key"].isin(taken)),
            F.filter(F.map_entries("one_tags"), lambda e: e["key"].isin(taken)))
        tags = F.map_from_entries(entries)
        key = key_text(tags)
    return _finish(joined, op, a, b, bool_result, key.alias("series_key"), tags.alias("tags"))


def scalar(left: DataFrame, op: str, number: float, bool_result: bool = False) -> DataFrame:
    """``vector op number`` row by row."""
    return _finish(left, op, F.col("value"), F.lit(float(number)), bool_result,
                   "series_key", "tags")


def scalar_left(number: float, op: str, right: DataFrame, bool_result: bool = False) -> DataFrame:
    """``number op vector`` row by row; a filtering comparison keeps the vector's values."""
    if op in COMPARISONS and not bool_result:
        mirrored = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}.get(op, op)
        return scalar(right, mirrored, number)
    return _finish(right, op, F.lit(float(number)), F.col("value"), bool_result,
                   "series_key", "tags")


def _filtered(left: DataFrame, right: DataFrame, on, ignoring, how: str,
              spread: int) -> DataFrame:
    """Left rows by whether the right has their key: a left key with very many rows is split
    by adaptive execution, or spread on request."""
    keyed, keys = _with_match(left, on, ignoring)
    present, _ = _with_match(right, on, ignoring)
    return _spread_join(keyed, present.select(*keys, "step_ts").distinct(), keys, how, spread) \
        .select(*left.columns)


def vector_and(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None,
               ignoring: Sequence[str] | None = None, spread: int = 1) -> DataFrame:
    """Left rows with a match on the right."""
    return _filtered(left, right, on, ignoring, "left_semi", spread)


def vector_unless(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None,
                  ignoring: Sequence[str] | None = None, spread: int = 1) -> DataFrame:
    """Left rows without a match on the right."""
    return _filtered(left, right, on, ignoring, "left_anti", spread)


def vector_or(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None,
              ignoring: Sequence[str] | None = None, spread: int = 1) -> DataFrame:
    """All left rows, and the right rows without a match on the left."""
    return left.unionByName(vector_unless(right, left, on, ignoring, spread)
                            .select(*left.columns))
