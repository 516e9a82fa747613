"""Composition: sources and operators are plain functions on DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import durable

Source = Callable[[SparkSession], DataFrame]
Step = Callable[[DataFrame], DataFrame]


def run(spark: SparkSession, source: Source, *steps: Step) -> DataFrame:
    """A source and the operators applied to it, as one lazy plan."""
    return reduce(lambda df, step: df.transform(step), steps, source(spark))


def from_parents(parents: Mapping[str, DataFrame], step: Callable[[DataFrame, list[str]], DataFrame]
                 ) -> DataFrame:
    """One operator fed by several parents, each block on its own: the parents are joined
    end to end with a ``parent`` column, which the operator gets as a grouping column."""
    if not parents:
        raise ValueError("no parent given")
    marked = [df.withColumn("parent", F.lit(label)) for label, df in parents.items()]
    return step(reduce(lambda a, b: a.unionByName(b), marked), ["parent"])


def to_children(df: DataFrame, children: Mapping[str, Step]) -> dict[str, DataFrame]:
    """One source handed to several operators; each child is a lazy plan on it."""
    return {label: df.transform(step) for label, step in children.items()}


def write_children(df: DataFrame, children: Mapping[str, Step],
                   write: Callable[[str, DataFrame], None]) -> None:
    """Run all children and write each; the shared source is computed once, to the folder
    that all executors share."""
    for label, child in to_children(durable(df), children).items():
        write(label, child)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
