"""Equi-joins and anti-joins.

No side is broadcast on trust. Inner joins are left to adaptive execution, which
broadcasts a side once it has measured it and otherwise splits the partitions a
hot key makes too large. For that split both inputs must come straight out of a
shuffle on the join key, so nothing here is aggregated on the join key just before
the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def inner_renamed(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join on two differently named columns; both stay. Null keys never match."""
    return left.join(right, left[left_key] == right[right_key], "inner")


def unseen(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (left anti join).

    A null key never matches, so such rows always count as unseen; with
    ``null_safe=True`` null equals null. Copies within the batch all stay. The
    column order of the batch is kept.

    The target's keys are made distinct first, within each task as well, so its copies
    do not travel. A hash of the keys is joined on beside them: the distinct keys are then
    shuffled once more, which lets run-time planning split a hot key of the batch or
    broadcast the keys if they turn out to be few.
    """
    return anti_join(batch, target.select(*keys).distinct(), keys, null_safe)


def anti_join(
    batch: DataFrame, known: DataFrame, keys: Sequence[str], null_safe: bool = False, hashed: bool = True
) -> DataFrame:
    """Left anti join on equally named keys, with the column order of ``batch``.

    ``hashed`` joins on a hash of the keys, too, see ``unseen``. Where ``known`` is read from a table
    and the rows are not grouped by their keys afterwards, it is not needed and only travels.
    """
    renamed = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = [
        F.col(k).eqNullSafe(F.col(f"_known_{k}")) if null_safe else F.col(k) == F.col(f"_known_{k}")
        for k in keys
    ]
    rows = batch
    if hashed:
        rows = batch.withColumn("_hash", F.xxhash64(*keys))
        renamed = renamed.withColumn("_known_hash", F.xxhash64(*renamed.columns))
        same.append(F.col("_hash") == F.col("_known_hash"))
    matches = reduce(lambda a, b: a & b, same)
    return rows.join(renamed, matches, "left_anti").select(*batch.columns)


def enrich(
    entries: DataFrame, lookup: DataFrame, entry_key: str, lookup_key: str = "id"
) -> DataFrame:
    """The lookup record of every entry, as the struct column ``record``.

    ``lookup`` holds one row per key; entries without a record are dropped.
    """
    records = lookup.select(
        F.col(lookup_key).alias("_lookup_key"), F.struct(*lookup.columns).alias("record")
    )
    return entries.join(records, F.col(entry_key) == F.col("_lookup_key"), "inner").drop(
        "_lookup_key"
    )
