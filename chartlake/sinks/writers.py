"""Parquet and JSON sinks.

Partitioned writes first bring the rows of one partition value together with a
rebalance, so that a day is written by few tasks and not by all of them. Unlike a
plain repartition it also splits a day that is much larger than the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chartlake.sinks.staging import shuffles_removed
from chartlake.sources.readers import root_paths


class OverwriteOfInputError(ValueError):
    """The target of an overwrite is also read by the frame to be written."""


# Run-time planning joins shuffled partitions below this size although cores are idle.
LEAST_PARTITION = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
# A task that meets no more days than this keeps their files open, and need not sort its rows.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MOST_OPEN = 100


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in columns])


@contextmanager
def many_small_files(spark: SparkSession, unsorted: bool = False) -> Iterator[None]:
    """While the body writes, small partitions are joined only as far as all cores stay busy.

    A write by day opens a file per day, and that takes the time, not the bytes: by
    Spark's default a thousand tiny days would be one task. Large partitions are joined and
    split by the advisory size as ever. ``unsorted`` is for rows that are widened in the
    writing tasks: rows of few days are not sorted by day, which would hold them all in memory.
    """
    wanted = {LEAST_PARTITION: "1KB"} | ({OPEN_FILES: MOST_OPEN} if unsorted else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def overwrite_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table. Refused when ``df`` reads from it: its files would be gone mid-job."""
    if reads_from(df, path):
        raise OverwriteOfInputError(f"{path} is an input of the frame that would replace it")
    _write(df, path, "overwrite", partition_by)


def append_parquet(
    df: DataFrame, path: str, partition_by: str | None = None, rebalance: bool = True
) -> None:
    _write(df, path, "append", partition_by, rebalance)


# A compressed file is read by one task, so it holds no more documents than this.
JSON_ROWS = 500_000


def write_json(
    df: DataFrame, path: str, partition_by: str | None = None, rebalance: bool = True
) -> None:
    """Gzipped JSON lines, in few large files. Null fields are kept as null.

    Without ``rebalance`` the rows of one partition value must be together already.
    """
    if partition_by and rebalance:
        df = rebalanced(df, partition_by)
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": JSON_ROWS}
    writer = df.write.mode("overwrite").options(ignoreNullFields=False, **options)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with many_small_files(df.sparkSession, unsorted=not rebalance), shuffles_removed(df.sparkSession):
        writer.json(path)


def _write(
    df: DataFrame, path: str, mode: str, partition_by: str | None, rebalance: bool = True
) -> None:
    if partition_by and rebalance:
        df = rebalanced(df, partition_by)
    writer = df.write.mode(mode)
    if not partition_by:
        writer.parquet(path)
        return
    with many_small_files(df.sparkSession, unsorted=not rebalance):
        writer.partitionBy(partition_by).parquet(path)


def reads_from(df: DataFrame, path: str) -> bool:
    """Whether ``df`` scans ``path``, something under it, or a folder that holds it."""
    target = _parts(path)
    for root in root_paths(df):
        scheme, host, name = _parts(root)
        same_store = not target[0] or not scheme or (scheme, host) == target[:2]
        inside = (name + "/").startswith(target[2] + "/") or (target[2] + "/").startswith(name + "/")
        if same_store and inside:
            return True
    return False


def _parts(path: str) -> tuple[str, str, str]:
    parts = urlsplit(path)
    return parts.scheme, parts.netloc, "/" + unquote(parts.path).strip("/")


class Days:
    """The days of the rows of a frame, gathered while it is written.

    ``watch`` passes the rows through; after the write ``written`` holds their days. They are
    aggregated in the writing job itself, one short list a task, so neither the rows nor
    the folders are read again.
    """

    def __init__(self, column: str):
        self.column, self._seen = column, Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        day = F.col(self.column)
        return rows.observe(
            self._seen, F.collect_set(day).alias("days"), F.count_if(day.isNull()).alias("without")
        )

    def written(self) -> list[date | None]:
        found = self._seen.get
        return sorted(found["days"] or []) + [None] * bool(found["without"])
