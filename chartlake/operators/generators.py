"""Array to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_columns(df: DataFrame, names: Sequence[str], outer: bool = False) -> DataFrame:
    """Replace each array column by its elements, one after the other.

    Several columns give the cross product of the arrays of *one row*. Rows whose
    array is null or empty vanish; with ``outer=True`` they stay with a null.
    """
    generate = F.explode_outer if outer else F.explode
    for name in names:
        df = df.withColumn(name, generate(name))
    return df


def rank_entries(df: DataFrame, array: str, entry: str, position: str = "position") -> DataFrame:
    """One row per list element; ``position`` is its place in the list, from 1."""
    others = [F.col(c) for c in df.columns if c != array]
    return df.select(*others, F.posexplode(array).alias("_place", entry)).select(
        *others, entry, (F.col("_place") + 1).alias(position)
    )
