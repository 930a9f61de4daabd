"""Preview of a frame: its first rows and its schema, printed or as data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview_rows(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; which ones is only defined when an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def preview_schema(df: DataFrame) -> DataFrame:
    """One row per column: place, name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "place INT, name STRING, type STRING")


def print_preview(df: DataFrame, n: int = 20) -> None:
    df.show(n)
    df.printSchema()
