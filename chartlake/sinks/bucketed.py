"""Incremental append by id to a table that is stored in buckets of the id.

The files of a bucketed table say by themselves which ids they hold, so the known ids are
compared where they lie: only the batch is shuffled, never the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.sinks.staging import staged

BUCKETS = 64


def unseen_ids(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Distinct ids of ``batch`` that the bucketed ``target`` does not hold, null left out.

    Copies of a batch's id are dropped within each task before the shuffle, so an id that
    most rows have is one row a task here.
    """
    ids = batch.filter(F.col(key).isNotNull()).select(key).distinct()
    # The hint keeps the plan at every size: the batch goes to the buckets.
    return ids.hint("shuffle_merge").join(target.select(key).distinct(), key, "left_anti")


def append_bucketed(
    batch: DataFrame, database: str, name: str, key: str, path: str | None = None, buckets: int = BUCKETS
) -> None:
    """Append the rows of ``batch`` whose ``key`` the table does not hold yet.

    The first write wins, copies within the batch stay, and rows with a null key are appended
    every time. The table is created with ``buckets`` buckets of the key if it does not
    exist; afterwards the number is that of the table. One writer per table.
    """
    spark, table = batch.sparkSession, f"`{database}`.`{name}`"
    rows = batch
    if spark.catalog.tableExists(table):
        buckets = bucket_count(spark, database, name)
        known = spark.table(table)
        # Staged, so that the join below splits an id that most rows of the batch have.
        fresh = staged(unseen_ids(batch, known, key), "unseen-ids")
        rows = batch.join(fresh, key, "left_semi").select(*batch.columns).unionByName(
            batch.filter(F.col(key).isNull())
        )
    writer = rows.write.mode("append").bucketBy(buckets, key).sortBy(key).format("parquet")
    if path and not spark.catalog.tableExists(table):
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def bucket_count(spark: SparkSession, database: str, name: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{name}`")
    return int(described.filter("col_name = 'Num Buckets'").first()["data_type"])
