"""Intermediate tables in the folder that all executors share.

A frame that several writes depend on is written once and read back. Unlike a cache
the copy survives lost executors, and later readers get column pruning on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from chartlake.sources.readers import listing_by_cores, root_paths

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"

# The tables staged within the innermost ``scratch`` block.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset it is ``_staging`` under ``spark.sql.warehouse.dir``, the folder
    that Spark's own tables share. On a cluster that folder must not be a local one.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE).rstrip("/")
    if warehouse.startswith(("/", "file:")) and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share; {warehouse} is a local one")
    return f"{warehouse}/_staging"


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path that is deleted when the innermost ``scratch`` block ends, if there is one."""
    path, opened = new_path(spark, name), _staged.get()
    if opened is not None:
        opened.append(path)
    return path


# Spark otherwise deletes shuffled files only once the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What the queries planned in the block shuffle is deleted when each of them ends."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


# Bytes of a row group of a staged table: later reads share a file out by row groups.
ROW_GROUP = 16 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    A task that writes most of the rows, from one long list, leaves one large file of many row
    groups. Later reads split it at these, so the rows need no shuffle to be evened out.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.options(**{"compression": "zstd", "parquet.block.size": ROW_GROUP}).parquet(path)
    return listing_by_cores(df.sparkSession).read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete what is staged within the block when it ends, except for what is still read.

    The block gets a function ``keep``: a frame passed through it leaves all staged tables
    that it reads in place, those of a surrounding block take over. Frames that are not
    passed on must have been written or collected by then.
    """
    opened: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.update(root.rstrip("/").rsplit("/", 1)[-1] for root in root_paths(df))
        return df

    token = _staged.set(opened)
    try:
        yield keep
    finally:
        _staged.reset(token)
        outer = _staged.get()
        for path in opened:
            if path.rsplit("/", 1)[-1] not in kept:
                remove(spark, path)
            elif outer is not None:
                outer.append(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table; Spark's own file system client does it, whatever the store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
