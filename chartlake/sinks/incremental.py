"""Append only what the target does not hold yet.

One writer per table: two jobs that append to the same table at the same time can
both find a key missing and both write it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.operators.joins import anti_join
from chartlake.sinks.narrowing import narrowed, too_many_to_broadcast
from chartlake.sinks.staging import staged
from chartlake.sinks.writers import Days, append_parquet, overwrite_parquet
from chartlake.sources.readers import read_parquet_if_exists


def incremental_append(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: str | None = None,
    days: DataFrame | None = None,
    null_safe: bool = False,
    schema: str | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    rebalance: bool = True,
    written: Days | None = None,
    wide: bool = False,
) -> None:
    """Append the rows of ``batch`` whose key is not in the Parquet table at ``path``.

    The first write wins: a key that is there is neither changed nor added to. Copies
    within the batch all stay. Only the key columns of the target are read.

    With ``partition_by`` only the partitions of the target from the first to the last
    value in the batch are read. ``days`` is a frame with that column alone from which
    these two bounds are cheaper to get than from the batch; it must hold every value of
    the batch. However many days there are, one row reaches the driver.

    ``finish`` is applied to the unseen rows before they are written. Work that
    multiplies rows and keeps the key columns belongs there, because then it is done
    neither for seen rows nor before a shuffle.

    ``written`` gathers the days of the appended rows while they are written, so that a
    registered table can be given just these.

    ``wide`` is for batches that are much wider than their keys and can be read twice: if the
    known keys are too many to be broadcast, the first reading finds the unseen keys, so that
    the second shuffles hardly any row that is not appended.
    """
    target = read_parquet_if_exists(batch.sparkSession, path, schema)
    if target is not None:
        if partition_by in keys:
            target = within_days(target, days if days is not None else batch, partition_by, null_safe)
        # Written, the known keys have a size: if it is small they are broadcast, and the far
        # wider batch is not shuffled for them.
        known = staged(target.select(*keys).distinct(), "known-keys")
        if wide and too_many_to_broadcast(known):
            batch, known = narrowed(batch, known, keys, null_safe)
        batch = anti_join(batch, known, keys, null_safe)
    rows = finish(batch) if finish else batch
    rows = written.watch(rows) if written else rows
    if target is None and not partition_by:
        overwrite_parquet(rows, path)
    else:
        append_parquet(rows, path, partition_by, rebalance)


def within_days(target: DataFrame, days: DataFrame, column: str, null_safe: bool = False) -> DataFrame:
    """The rows of ``target`` whose ``column`` lies between the bounds of ``days``.

    The bounds become filters on the target's partitions. Values in between that the batch
    does not hold are dropped by a semi-join, which prunes further at run time where the
    batch has a selective filter of its own.
    """
    low, high = days.agg(F.min(column), F.max(column)).first()
    day = F.col(column)
    if low is None:
        return target.filter(day.isNull() if null_safe else F.lit(False))
    known = target.filter(day.between(F.lit(low), F.lit(high)))
    known = known.join(days.select(column).distinct(), column, "left_semi").select(*target.columns)
    return known.unionByName(target.filter(day.isNull())) if null_safe else known
