"""Leave rows out before they are joined to anything, if only their keys are needed for that."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.operators.joins import anti_join
from chartlake.sinks.staging import staged
from chartlake.sources.readers import byte_count, file_relations

# The bits that Spark's bitmap functions put in one bitmap.
BITS = 1 << 15
# A key sets one bit in each of this many bitmaps.
HASHES = 3
# Keys share bitmaps until a key has this many bits; then one absent key in 200 passes.
BITS_A_KEY = 16
# All bitmaps are broadcast, so they never take more than 64 MB; with more keys more rows pass.
MOST_BLOCKS = (64 << 23) // (BITS * HASHES)


def too_many_to_broadcast(written: DataFrame) -> bool:
    """Whether the planner would shuffle for a join to this table instead of broadcasting it.

    Half of its threshold is taken, since the join adds a column to the keys.
    """
    most = byte_count(written.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return 2 * sum(relation.location().sizeInBytes() for relation in file_relations(written)) > most


def narrowed(
    batch: DataFrame, known: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of both that can matter to ``anti_join(batch, known, keys)``, and a few others.

    ``known`` must be a written table. Which keys are unseen is found from the key columns
    alone, so the other columns are not shuffled for it. The unseen keys are put into bitmaps by
    their hashes. All rows of ``batch`` that the anti-join keeps pass these, and so do few seen
    ones; only the known keys that pass as well are needed to drop them.
    """
    unseen = staged(anti_join(batch.select(*keys), known, keys, null_safe, hashed=False), "unseen-keys")
    passing = passing_by(unseen, keys)
    return passing(batch), staged(passing(known.select(*keys)), "known-keys")


def passing_by(wanted: DataFrame, keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """A filter that all rows with a key of the written table ``wanted`` pass, and few others.

    It is a join to broadcast bitmaps, so it shuffles nothing.
    """
    blocks = min(max(1, -(-wanted.count() * BITS_A_KEY // (BITS * HASHES))), MOST_BLOCKS)
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks))
    bitmaps = staged(
        wanted.select(block.alias("_held_block"), *[_place(keys, i).alias(f"_place_{i}") for i in range(HASHES)])
        .groupBy("_held_block")
        .agg(*[_longs(F.bitmap_construct_agg(f"_place_{i}")).alias(f"_held_{i}") for i in range(HASHES)]),
        "bitmaps",
    )

    def passing(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(bitmaps), block == F.col("_held_block"))
        for i in range(HASHES):
            joined = joined.filter(_holds(F.col(f"_held_{i}"), _place(keys, i)))
        return joined.select(*df.columns)

    return passing


def semi_join(wide: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``wide`` whose key is in the written table ``wanted``.

    If that has too many keys to be broadcast, the keys of ``wide`` that are not in it are
    found from the key columns alone, and the rows of these are left out. ``wide`` is read twice.
    """
    if not too_many_to_broadcast(wanted):
        return wide.join(wanted.select(*keys), list(keys), "left_semi").select(*wide.columns)
    named = wide.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    others = staged(anti_join(named.select(*keys), wanted, keys, hashed=False), "other-keys")
    if too_many_to_broadcast(others):
        named, others = narrowed(named, others, keys)
    return anti_join(named, others, keys)


def _place(keys: Sequence[str], i: int) -> Column:
    """A place in a bitmap by 15 bits of a hash that is not the one the block is chosen by."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(1), *keys), 15 * i).bitwiseAND(F.lit(BITS - 1))


def _longs(bits: Column) -> Column:
    """A bitmap as numbers of 64 bits, which are quicker to test than its bytes."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BITS // 64 - 1)),
        lambda n: F.conv(F.hex(F.substring(bits, n * 8 + 1, F.lit(8))), 16, -10).cast("long"),
    )


def _holds(longs: Column, place: Column) -> Column:
    # Of a number the first byte is the highest, of a bitmap the lowest.
    number, bit = F.shiftright(place, 6).cast("int"), place.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56))
    return F.getbit(F.get(longs, number), bit.cast("int")) == 1
