"""Mixing sources to target weights (native).

The words of each source are packed into blocks of fixed length. Every output shard draws
how many blocks it takes of each source; a source's slots run through a pseudorandom
permutation of its block numbers, and blocks are joined by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartlake.llm.shared import WORD, chosen, numbered, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2
BLOCK_WORDS = 128
# A source has at least so many blocks, or one for each word, so its blocks may be shorter.
LEAST_BLOCKS = 4096
# Blocks are made longer than asked for when a mix would have more slots than this.
MOST_SLOTS = 1 << 30
SHARD_BLOCKS = 8192
CELL_ROWS = 4096
# Primes just below 2^31. A source has fewer blocks, so each is coprime to any block count.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549)


def permuted(x: Column, n: Column, seed: Column) -> Column:
    """A bijection of 0..n-1, n < 2^31, that depends on ``seed``.

    Two rounds of an affine map modulo n, each followed by a shift-xor of the numbers
    below the largest power of two in n, which is a bijection of those numbers.
    """
    bits = F.floor(F.log2(n + 0.5)).cast("int")
    power = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    half = F.greatest(F.lit(1), F.floor((bits + 1) / 2)).cast("int")
    for turn in (1, 2):
        prime = F.element_at(
            F.array(*[F.lit(p) for p in PRIMES]), (F.pmod(seed + turn, F.lit(len(PRIMES))) + 1).cast("int")
        ).cast("long")
        x = F.pmod(prime * x + seed * 7919 + turn, n)
        x = F.when(x < power, x.bitwiseXOR(F.call_function("shiftright", x, half))).otherwise(x)
    return x


def source_targets(entries: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """(source_no, source, source_size, target) from entries (source, size).

    Sources in code point order, null last, take the weights in turn. Filling stops at
    the ceiling, and what is left over is shared again by weight: sources fill up in the
    order of ceiling to weight, so the level is found in one ordered pass over sources.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    sources = (
        entries.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
        .withColumn("source_no", F.row_number().over(in_order) - 1)
        .withColumn(
            "weight",
            F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1),
        )
        .withColumn("full", F.col("source_size") * CEILING)
        .withColumn("ratio", F.col("full") / F.col("weight"))
    )
    left_words = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(
        F.sum("full").over(by_ratio), F.lit(0)
    )
    left_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(by_ratio), F.lit(0)
    )
    return (
        sources.withColumn("level", left_words / left_weight)
        .withColumn(
            "level",  # that of the first source, in the order of filling, which does not fill up
            F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source_no", "level")))
            .over(everything)["level"],
        )
        .withColumn(
            "target",
            F.least(
                F.col("full").cast("double"),
                F.coalesce(F.col("level") * F.col("weight"), F.col("full").cast("double")),
            ),
        )
        .select("source_no", "source", "source_size", "source_rows", "target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    key_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(pieces, slots) of the mix.

    All blocks of a source have the same length: ``block_words``, less for a source that
    would have fewer than ``LEAST_BLOCKS`` blocks, so that a short source meets its target
    too, and more for a mix of over 2^30 blocks.

    ``pieces``: doc_id, source, size, source_size, target, start, block, words: which words
    of which document a block holds; documents without words have a null block.
    ``slots``: source, shard, slot, block: what each output shard takes. A block is taken
    at most twice, since a target is at most twice its source's words.

    The draw of a shard is multinomial conditioned on the totals: all slots of the mix are
    dealt to the shards by a permutation of the slot numbers. Free draws would miss the
    targets at random and break the ceiling.

    Null texts and texts without words have size 0. Null sources form one source, which
    stands last. Null ids sort first. Rows equal in id, size and source are
    interchangeable. ``key_col`` names a column that goes along as ``key`` and decides
    nothing. Empty tables give no rows. Reruns agree, as nothing is random.
    """
    along = {"key": key_col} if key_col else {}
    entries = staged(
        chosen(docs, doc_id=id_col, text=text_col, source=source_col, **along).select(
            "doc_id",
            "source",
            *along,
            F.coalesce(F.expr(f"regexp_count(text, r'{WORD}')"), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    everything = Window.partitionBy(F.lit(0))
    asked = F.greatest(
        F.lit(block_words), F.ceil(F.sum("source_size").over(everything) * F.lit(share) / F.lit(MOST_SLOTS))
    )
    sources = staged(
        source_targets(entries, weights, share)
        .withColumn(
            "length",
            F.greatest(F.lit(1), F.least(asked, F.floor(F.col("source_size") / LEAST_BLOCKS))).cast("long"),
        )
        .withColumn("blocks", F.coalesce(F.ceil(F.col("source_size") / F.col("length")), F.lit(0)))
        .withColumn(
            "quota",
            F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("blocks")))
            .otherwise(0)
            .cast("long"),
        )
        .withColumn("first", F.coalesce(F.sum("quota").over(
            Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("all", F.sum("quota").over(everything))
        .withColumn(
            "blocks",  # only some 100,000 sources, each with many short blocks, come to this
            F.when(F.greatest("blocks", "all") >= PRIMES[-1], F.raise_error(F.lit("too many blocks")))
            .otherwise(F.col("blocks")),
        ),
        "sources",
    )

    # Packing: where each document starts in the words of its source.
    cells = F.ceil(F.col("source_rows") / F.lit(CELL_ROWS))
    joined = entries.join(
        sources.select("source", "source_no", "source_size", "source_rows", "target", "length"),
        entries["source"].eqNullSafe(sources["source"]),
    ).drop(sources["source"])
    cell = F.pmod(F.coalesce("doc_id", "size"), cells)
    packed = numbered(
        joined, ["source_no"], cell, [F.col("doc_id"), F.col("size")], F.col("size"), "start"
    )
    length = F.col("length")
    first, last = F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length)
    pieces = packed.select(
        "doc_id", "source", *along, "source_no", "size", "source_size", "target", "start", "length",
        F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))).alias("block"),
    ).withColumn(
        "words",
        F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * length)
        - F.greatest(F.col("start"), F.col("block") * length),
    )

    # Few short rows grow to many below, so their number of tasks is given: run-time planning
    # would join them into one by their size.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # The draw: how many blocks of each source a shard takes.
    chunk = F.lit(1 << 16).cast("long")
    drawn = (
        sources.filter("quota > 0")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / chunk))))
        .repartition(tasks, "source_no", "chunk")
        .withColumn("k", F.explode(F.sequence(
            F.col("chunk") * chunk, F.least((F.col("chunk") + 1) * chunk, F.col("quota")) - 1)))
        .withColumn("turn", permuted(F.col("first") + F.col("k"), F.col("all"), F.lit(3).cast("long")))
        .groupBy("source_no", F.floor(F.col("turn") / shard_blocks).alias("shard"))
        .agg(F.count("*").alias("n"))
    )
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        drawn.withColumn("from", F.coalesce(F.sum("n").over(before), F.lit(0)))
        # One row a source and shard up to here; a shard's slots are made in a task of their own.
        .repartition(tasks, "source_no", "shard")
        .withColumn("slot", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)))
        .join(sources.select("source_no", "source", "blocks"), "source_no")
        .withColumn("epoch", F.floor(F.col("slot") / F.col("blocks")))
        .withColumn("block", permuted(
            F.pmod("slot", "blocks"), F.col("blocks"), F.col("source_no") * 31 + F.col("epoch") * 17))
        .select("source", "source_no", "shard", "slot", "block")
    )
    return pieces, slots


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, shards; key if asked.

    ``taken`` are the words of the document that the mix takes, repeats counted, and
    ``shards`` lists how many of them each output shard takes (shard, words), by shard; see
    :func:`mix` for nulls, empty texts, ties and repeated rows.
    """
    pieces, slots = mix(docs, **options)
    times = slots.groupBy("source_no", "block", "shard").agg(F.count("*").alias("times"))
    along = ["key"] if options.get("key_col") else []
    row = ["source_no", "start", "doc_id", "source", *along, "size", "source_size", "target"]
    whole = pieces.filter("size > 0")
    by_shard = (
        whole.join(times, ["source_no", "block"], "left")
        .groupBy(*row, "shard")
        .agg(F.sum(F.coalesce("times", F.lit(0)) * F.col("words")).alias("words"))
    )
    taken = by_shard.groupBy(*row).agg(
        F.sum("words").alias("taken"),
        F.array_sort(F.collect_list(F.when(F.col("words") > 0, F.struct("shard", "words")))).alias("shards"),
    )
    columns = ["doc_id", "source", *along, "size", "source_size", "target", "taken", "shards"]
    none = F.array().cast("array<struct<shard: bigint, words: bigint>>")
    return taken.select(*columns).unionByName(
        pieces.filter("size = 0").withColumns({"taken": F.lit(0).cast("long"), "shards": none}).select(*columns)
    )
