"""The CSV job and the order total job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.functions.columns import from_json_text, map_total, two_decimals
from chartlake.sinks.preview import print_preview
from chartlake.sinks.writers import overwrite_parquet
from chartlake.sources.readers import read_csv


def csv_to_parquet(
    spark: SparkSession, source: str, path: str, schema: str | None = None, show: bool = True
) -> None:
    """Replace the table at ``path`` by the CSV files at ``source``."""
    df = read_csv(spark, source, schema)
    if show:
        print_preview(df)
    overwrite_parquet(df, path)


def order_totals(df: DataFrame, text: str) -> DataFrame:
    """Total of a JSON object of numbers, as a number and as text with two decimals."""
    total = map_total(from_json_text(F.col(text), "map<string,double>"))
    return df.withColumn("total_order_value", total).withColumn(
        "total_text", two_decimals(F.col("total_order_value"))
    )
