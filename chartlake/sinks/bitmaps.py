"""Incremental append that looks keys up in stored bitmaps instead of in the table.

Beside a table by day stands a small table of the positions that each day holds: one bitmap
of 32,768 positions a row. A batch is joined to the bitmaps of its days, and a bit says
whether a key is there. The rows of the table itself are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.sinks.incremental import within_days
from chartlake.sinks.staging import staged
from chartlake.sinks.writers import append_parquet, overwrite_parquet
from chartlake.sources.readers import read_parquet, read_parquet_if_exists

COLUMNS = "bucket BIGINT, bits BINARY, rows BIGINT"


def bitmap_path(path: str) -> str:
    return f"{path.rstrip('/')}-keys"


def key_bitmaps(rows: DataFrame, position: str, day: str) -> DataFrame:
    """(day, bucket, bits, rows): the positions of each day; ``rows`` counts all its rows.

    Rows without a position or a day have no key. They are counted under a null bucket.
    """
    at = F.when(F.col(day).isNotNull(), F.col(position).cast("long"))
    return rows.select(
        F.col(day), F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")
    ).groupBy(day, "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"), F.count("*").alias("rows")
    )


def joined_bitmaps(stored: DataFrame, day: str) -> DataFrame:
    """The bitmaps of all loads as one a day and bucket."""
    return stored.groupBy(day, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("rows").alias("rows")
    )


def holds(bits: Column, bit: Column) -> Column:
    """Whether a bitmap has a position; bits count from the lowest of the first byte."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(F.coalesce(byte, F.lit(0)), F.pmod(bit, F.lit(8)).cast("int")) == 1


def unseen_by_bitmap(batch: DataFrame, bitmaps: DataFrame, position: str, day: str) -> DataFrame:
    """Rows of ``batch`` whose position the bitmap of their day does not have.

    ``bitmaps`` has one row a day and bucket. Rows with a null key always count as unseen.
    """
    own = bitmaps.select(
        F.col(day).alias("_day"), F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")
    )
    at = F.col(position).cast("long")
    probed = batch.withColumns(
        {"_at": F.bitmap_bucket_number(at), "_bit": F.bitmap_bit_position(at)}
    ).join(own, (F.col(day) == F.col("_day")) & (F.col("_at") == F.col("_bucket")), "left")
    seen = F.coalesce(holds(F.col("_bits"), F.col("_bit")), F.lit(False))
    return probed.filter(~seen).select(*batch.columns)


def append_by_bitmap(batch: DataFrame, path: str, position: str, partition_by: str) -> None:
    """Append the rows whose (``position``, day) the table at ``path`` does not hold.

    The same rows as ``incremental_append`` with these keys: the first write wins, copies
    within the batch stay, and rows with a null key are appended every time. ``position``
    must be a whole number.

    The bitmaps are written after the rows. A job that ended in between leaves fewer rows
    counted than the table has; the next one sees that from the file footers and makes the
    bitmaps anew, so no key is written twice. One writer per table.
    """
    spark = batch.sparkSession
    target = read_parquet_if_exists(spark, path)
    if target is None:
        fresh = staged(batch, "unseen")
        append_parquet(fresh, path, partition_by)
        overwrite_parquet(key_bitmaps(fresh, position, partition_by), bitmap_path(path))
        return
    bitmaps = current_bitmaps(spark, path, target, position, partition_by)
    days = batch.select(partition_by).distinct()
    # Staged, so that the join can split a day that most of the batch lies in.
    own = staged(joined_bitmaps(within_days(bitmaps, days, partition_by), partition_by), "own-keys")
    fresh = staged(unseen_by_bitmap(batch, own, position, partition_by), "unseen")
    append_parquet(fresh, path, partition_by)
    key_bitmaps(fresh, position, partition_by).write.mode("append").parquet(bitmap_path(path))


def current_bitmaps(
    spark: SparkSession, path: str, target: DataFrame, position: str, partition_by: str
) -> DataFrame:
    """The stored bitmaps, made anew from the table if they do not account for all its rows."""
    kind = dict(target.dtypes)[partition_by]
    stored = read_parquet_if_exists(spark, bitmap_path(path), f"`{partition_by}` {kind}, {COLUMNS}")
    counted = stored.agg(F.sum("rows")).first()[0] or 0 if stored is not None else -1
    if counted == target.count():  # from the footers
        return stored
    fresh = staged(key_bitmaps(target, position, partition_by), "bitmaps")
    overwrite_parquet(fresh, bitmap_path(path))
    return read_parquet(spark, bitmap_path(path))
