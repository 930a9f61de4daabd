"""Exact duplicates through an extendible-hash index on shared files (native).

The index is a table of narrow entries, one per document, written to the shared folder.
A directory of hash prefixes is doubled until no bucket holds more than ``capacity``
distinct hashes; owner tasks take ranges of buckets. Entries of one hash are chained,
and the chain is split by comparing the bytes of the texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartlake.llm.shared import SPACE, chosen, staged

CAPACITY = 20_000
SALTS = 64


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def address(key: Column, depth: int | Column) -> Column:
    """The first ``depth`` bits of a 64-bit hash; at depth 0 there is one bucket."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", key, (F.lit(64) - depth).cast("int"))
    )


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for each slot at the global depth, and that depth.

    ``keys`` holds each hash once, so copies never overfill a bucket; they chain. The
    start depth is the one at which buckets would be half full, and every doubling only
    looks at the hashes of buckets that are still overfull. The directory's size follows
    from the number of hashes and the capacity, so it stays a table.
    """
    total = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, 2 * total / capacity))))
    unsettled, leaves = keys, None
    while True:
        counts = unsettled.groupBy(address(F.col("key"), depth).alias("bucket")).agg(
            F.count("*").alias("n")
        )
        counts = staged(counts, "buckets")
        good = counts.filter(F.col("n") <= capacity).select("bucket", F.lit(depth).alias("depth"))
        leaves = good if leaves is None else leaves.unionByName(good)
        full = counts.filter(F.col("n") > capacity).select("bucket")
        if depth >= 62 or full.isEmpty():
            break
        unsettled = unsettled.withColumn("bucket", address(F.col("key"), depth)).join(
            full, "bucket", "left_semi"
        ).drop("bucket")
        depth += 1
    fan_out = F.expr(f"cast(1 as bigint) << ({depth} - depth)")
    slots = leaves.select(
        F.explode(
            F.sequence(F.col("bucket") * fan_out, F.col("bucket") * fan_out + fan_out - 1)
        ).alias("slot"),
        "bucket",
        "depth",
    )
    return slots, depth


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when identical without ASCII white space. The row with the most code
    points in its original text stays, then the smallest id.

    Null and empty texts are equal to each other and to texts of white space. A null id
    sorts last; if it wins, ``keep_id`` is null. Of rows that are equal in id and text
    exactly one is kept. An empty table gives no rows. Other columns are ignored. Two
    different texts of one SHA-256 would stop the job rather than merge.
    """
    texts = chosen(docs, doc_id=id_col, text=text_col)
    bare = texts.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        normalised(F.col("text")).alias("norm"),
    ).withColumns({"key": F.xxhash64("norm"), "sha": F.unhex(F.sha2("norm", 256))})

    entries = staged(
        bare.groupBy("doc_id", "points", "key", "sha").agg(F.count("*").alias("copies")), "entries"
    )
    first = F.struct(
        (-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id"
    )
    # A hot group shrinks to a row per salt before it meets its owner.
    salted = entries.groupBy("key", "sha", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")).agg(
        F.sum("copies").alias("n"), F.min(first).alias("first")
    )
    keys = staged(salted.groupBy("key").agg(F.sum("n").alias("n")), "keys")
    slots, depth = directory(keys.select("key"), capacity)
    index = staged(
        salted.withColumn("slot", address(F.col("key"), depth)).join(slots, "slot").drop("slot"),
        "index",
    )

    # Bytes are compared by grouping on the texts themselves: copies collapse within each
    # task, every different text is shuffled once whatever the sizes are, and texts that
    # share a hash but differ give it a second row.
    compared = (
        bare.groupBy("key", "sha", "norm")
        .agg(F.lit(1).alias("one"))
        .groupBy("key", "sha")
        .agg(F.count("*").alias("texts"))
        .filter("texts > 1")
        .hint("merge")
    )
    # Owner tasks: each takes a range of buckets, and the chain of a hash is in one of them.
    along = Window.partitionBy("bucket", "key").orderBy("sha")
    same = F.when(
        F.coalesce("texts", F.lit(1)) > 1, F.raise_error(F.lit("two texts have one SHA-256")).cast("boolean")
    ).otherwise(True)
    owned = (
        index.repartitionByRange("bucket", "key")
        .groupBy("bucket", "key", "sha")
        .agg(F.sum("n").alias("group_size"), F.min("first").alias("first"))
        .withColumn("chain", F.row_number().over(along))
        .join(compared, ["key", "sha"], "left")
        .filter(same)
        .drop("texts")
    )
    wins = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("points") == -F.col("first.points"))
    )
    return (
        entries.join(owned, ["key", "sha"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            "doc_id",
            F.col("first.doc_id").alias("keep_id"),
            "group_size",
            (wins & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
            "bucket",
            "chain",
        )
    )
