"""The incremental loads driven by newly arrived files.

A file stream remembers in its checkpoint which landed files it has read, so each
run parses only the new ones; the load itself is the same as in a batch run and
still skips keys the table holds. A batch repeated after a failure therefore adds no
key twice. Rows with a null key never match; ``append_new_files`` keeps the number of the
batch with its rows, so that a repeated batch replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartlake.operators.joins import unseen
from chartlake.sources.readers import read_parquet_if_exists

# The folder of a batch under its table.
BATCH = "load_batch"


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    load: Callable[[DataFrame], None],
    checkpoint: str,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a query that hands every batch of new JSON files to ``load`` and then stops."""
    return _start(spark, source, schema, lambda batch, _: load(batch), checkpoint, max_files_per_batch)


def append_batch(
    batch: DataFrame, number: int, path: str, keys: Sequence[str], null_safe: bool = False
) -> None:
    """Append the unseen rows of batch ``number`` to the table at ``path``.

    The table is laid out by batch: the folder names are the ledger of the batches that it
    holds, and they stand or fall with the rows. A batch that comes again is compared with
    the other batches only and replaces its own folder as a whole, so its rows, also those
    with a null key, are there once. A batch without unseen rows leaves no folder.
    """
    spark = batch.sparkSession
    target = read_parquet_if_exists(spark, path)
    if target is not None:
        others = target.filter(F.col(BATCH) != number)
        batch = unseen(batch, others, keys, null_safe)
    (
        batch.withColumn(BATCH, F.lit(number).cast("long"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH).parquet(path)
    )


def append_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    max_files_per_batch: int | None = None,
    null_safe: bool = False,
) -> StreamingQuery:
    """Start a query that appends the new JSON files under ``source``, every row once."""

    def load(batch: DataFrame, number: int) -> None:
        append_batch(batch, number, path, keys, null_safe)

    return _start(spark, source, schema, load, checkpoint, max_files_per_batch)


def _start(
    spark: SparkSession,
    source: str,
    schema: str,
    load: Callable[[DataFrame, int], None],
    checkpoint: str,
    max_files_per_batch: int | None,
) -> StreamingQuery:
    reader = spark.readStream.schema(schema).format("json")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return (
        reader.load(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
