"""Tables that a job changes in place: newer documents, compaction, and tables it reads.

What is written is always complete before anything old goes: changed days are staged in the
shared folder first and then exchanged as whole partitions, and a table that a job reads is
written to a new folder to which the catalog is switched.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.operators.aggregates import latest_by_key
from chartlake.sinks.catalog import quoted
from chartlake.sinks.incremental import within_days
from chartlake.sinks.staging import staged
from chartlake.sinks.writers import append_parquet, many_small_files, rebalanced
from chartlake.sources.readers import listing_by_cores, partition_columns, read_parquet, read_parquet_if_exists, root_paths


# --- newer documents ----------------------------------------------------------


def replace_newer(
    batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition_by: str
) -> None:
    """Put the rows of ``batch`` into the table at ``path``, newer ones in place of older.

    Of the rows of one key the last by ``order`` stays, and what is in the table stays at a
    tie. ``partition_by`` must be one of the keys. Only days in which a row of the batch is
    new or newer are rewritten; the files of all others are not touched. Rows with a null
    key all stay, so a batch with such rows rewrites the days in which they lie.

    The day of a key cannot change: a key lies in its day. One writer per table.
    """
    if partition_by not in keys:
        raise ValueError(f"{partition_by} must be one of the keys")
    spark = batch.sparkSession
    target = read_parquet_if_exists(spark, path)
    if target is None:
        append_parquet(latest_by_key(batch, keys, order), path, partition_by)
        return
    batch = staged(latest_by_key(batch, keys, order), "batch")
    held = within_days(target, batch, partition_by, null_safe=True)
    # Newer: no row of the same key in the table is as new. Keys and order alone are compared.
    both = batch.select(*keys, *order).withColumn("_old", F.lit(0)).unionByName(
        held.select(*keys, *order).withColumn("_old", F.lit(1))
    )
    fresh = latest_by_key(both, keys, [*order, "_old"]).filter("_old = 0")
    days = staged(fresh.select(F.col(partition_by).alias("_day")).distinct(), "changed-days")
    rows = batch.withColumn("_old", F.lit(0)).unionByName(held.withColumn("_old", F.lit(1)))
    changed = rows.join(days, F.col(partition_by).eqNullSafe(F.col("_day")), "left_semi")
    merged = latest_by_key(changed, keys, [*order, "_old"]).drop("_old")
    exchange_days(staged(merged.select(*target.columns), "merged"), path, partition_by)


def exchange_days(rows: DataFrame, path: str, partition_by: str, spread: bool = True) -> None:
    """Replace the days that ``rows`` has by these rows; other days keep their files."""
    rows = rebalanced(rows, partition_by) if spread else rows
    with many_small_files(rows.sparkSession):
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_by).parquet(path)
        )


# --- compaction ---------------------------------------------------------------


def file_sizes(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """(file, bytes, day) of every data file, from a listing that tasks make; no file is read."""
    files = listing_by_cores(spark).read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
        F.col(partition_by).alias("day"),
    )


def best_fit(target_bytes: int):
    """A function for ``applyInPandas``: bins for the files of one day, largest file first.

    A file goes into the bin with the least room that still holds it. Files of the target
    size or more stay alone.
    """

    def pack(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values(["bytes", "file"], ascending=[False, True])
        room: list[tuple[int, int]] = []  # ascending
        bins = []
        for size in files["bytes"].tolist():
            at = bisect_left(room, (size, -1))
            free, number = room.pop(at) if at < len(room) else (max(target_bytes, size), len(bins))
            insort(room, (free - size, number))
            bins.append(number)
        return files.assign(bin=bins)

    return pack


def compact(
    spark: SparkSession, path: str, partition_by: str, max_files: int = 4, target_bytes: int = 128 << 20
) -> int:
    """Put the small files of a day together; returns how many days were rewritten.

    Only days with more than ``max_files`` files, and fewer after packing, are rewritten;
    their files are packed into bins of ``target_bytes`` and each bin becomes one file. The
    rows are staged before the days are exchanged. One writer per table.
    """
    files = file_sizes(spark, path, partition_by)
    many = files.groupBy("day").agg(F.count("*").alias("files")).filter(F.col("files") > max_files)
    listed = files.join(many, F.equal_null(files["day"], many["day"]), "left_semi")
    kind = dict(files.dtypes)["day"]
    packed = staged(
        listed.groupBy("day").applyInPandas(
            best_fit(target_bytes), f"file string, bytes long, day {kind}, bin long"
        ),
        "bins",
    )
    fewer = packed.groupBy("day").agg(F.count("*").alias("files"), F.countDistinct("bin").alias("bins"))
    days = staged(fewer.filter("bins < files").select(F.col("day").alias("_day")), "days")
    found = days.count()
    if not found:
        return 0
    table = read_parquet(spark, path)
    with_file = table.withColumn("_path", F.col("_metadata.file_path"))
    rows = within_days(with_file, days.toDF(partition_by), partition_by, null_safe=True).join(
        days, F.col(partition_by).eqNullSafe(F.col("_day")), "left_semi"
    )
    bins = packed.select(F.col("file").alias("_file"), "bin")
    numbered = rows.join(bins, F.col("_path") == F.col("_file"), "left").select(*table.columns, "bin")
    kept = staged(numbered, "compacted")
    # One task per bin, so that each bin becomes one file.
    exchange_days(kept.repartition(partition_by, "bin").drop("bin"), path, partition_by, spread=False)
    return found


# --- tables that the job reads ------------------------------------------------


def replace_table(df: DataFrame, database: str, name: str, root: str) -> str:
    """Replace a registered table by ``df``, which may read that very table.

    The rows go to a new folder under ``root``, and the table is pointed at it when they are
    all there; a job that fails leaves the table as it was. Readers that started before keep
    the old folder, which stays until it is deleted. Returns the new folder. Tables by day
    are changed with ``replace_newer`` and refused here.
    """
    spark, table = df.sparkSession, f"`{database}`.`{name}`"
    path = f"{root.rstrip('/')}/{name}/version={uuid.uuid4().hex}"
    exists = spark.catalog.tableExists(table)
    if exists and partition_columns(spark.table(table)):
        raise ValueError(f"{database}.{name} is laid out by day")
    df.write.parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    if exists and [f.name for f in spark.table(table).schema] == df.columns and (
        [t for _, t in spark.table(table).dtypes] == [t for _, t in df.dtypes]
    ):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted(path)}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{quoted(path)}'")
    spark.catalog.refreshTable(table)
    return path


def table_folder(spark: SparkSession, database: str, name: str) -> str:
    return root_paths(spark.table(f"`{database}`.`{name}`"))[0]
