"""Distinct, counting and concatenation per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chartlake.functions.columns import joined
from chartlake.sources.readers import bounded_tasks


def distinct_projection(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return bounded_tasks(df).select(*columns).distinct()


def group_concat(
    df: DataFrame, keys: Sequence[str], value: str, alias: str, separator: str = ", "
) -> DataFrame:
    """Distinct non-null values of each group in one text, in sorted order.

    Duplicates go first, in a hash aggregation that also runs before its shuffle, so
    a group that holds a large share of all rows is spread over its values and only
    these values, which are the result, are brought together. (``collect_set`` would
    save a shuffle, but its sort-based aggregation was twice as slow on rows with
    many copies.) A group with nothing but nulls gives the empty text.
    """
    values = distinct_projection(df, [*keys, value])
    return values.groupBy(*keys).agg(
        joined(F.array_sort(F.collect_list(value)), separator).alias(alias)
    )


def group_count(df: DataFrame, keys: Sequence[str], alias: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, where ``order`` says which one is later.

    Spark limits every group to one row before the shuffle as well as after it,
    so a key written very often sends one row per map task. Rows with a null in their key
    name no key: each of them stays, and they are spread like keys of their own.
    """
    return last_by_key(df, keys, order, 1)


def last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int) -> DataFrame:
    """The last ``count`` rows of each key, else as ``latest_by_key``.

    Rows are sorted by a hash of their key first: Spark's sort compares eight bytes of its first
    column, and many keys, such as days as texts, start with the same eight.
    """
    unnamed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    group = F.when(unnamed, F.monotonically_increasing_id()).otherwise(F.xxhash64(*keys))
    latest_first = Window.partitionBy("_group", *keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_group", group)
        .withColumn("_place", F.row_number().over(latest_first))
        .filter(F.col("_place") <= count)
        .drop("_place", "_group")
    )
