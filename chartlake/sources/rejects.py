"""JSON scans that keep what they could not read.

Lines are parsed once. Each becomes a row with the fields of the schema, and what did not
fit is marked and written apart in the same pass, with its file, so it can be mended and
read again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chartlake.sinks.staging import new_path

RECORD = "_corrupt_record"


class Scan(NamedTuple):
    """``good`` has the columns of the schema; ``rejects`` has (record, file, part_read)."""

    good: DataFrame
    rejects: DataFrame
    read: int
    rejected: int


def scan_with_rejects(spark: SparkSession, path: str, schema: str, root: str | None = None) -> Scan:
    """Read JSON lines with a fixed schema and split off those that do not fit it.

    A line is rejected if it is not a JSON object or if a listed field has a value of another
    type; fields that are missing or not listed are no fault. ``part_read`` of a reject holds
    the fields that could be read. Both sides are stored under ``root``, by default in the
    shared folder; counts come from the writing job itself.
    """
    target, seen = root or new_path(spark, "scan"), Observation()
    parsed = (
        spark.read.schema(f"{schema}, {RECORD} STRING")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).json(path)
        .withColumns({"_file": F.col("_metadata.file_path"), "_rejected": F.col(RECORD).isNotNull()})
    )
    parsed.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if("_rejected").alias("rejected")
    ).write.partitionBy("_rejected").parquet(target)
    both = spark.read.schema(parsed.schema).parquet(target)
    fields = [c for c in parsed.columns if c not in (RECORD, "_file", "_rejected")]
    return Scan(
        both.filter("NOT _rejected").select(*fields),
        both.filter("_rejected").select(
            F.col(RECORD).alias("record"), F.col("_file").alias("file"), F.struct(*fields).alias("part_read")
        ),
        seen.get["read"],
        seen.get["rejected"],
    )
