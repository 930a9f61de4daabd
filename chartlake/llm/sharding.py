"""Sharding into contiguous parts of nearly equal bytes (native).

Equal texts form an atomic group. Groups stand in hash order; the smallest capacity for
which a greedy walk needs no more than the given number of shards is found by binary
search, and the walk's cuts are taken.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartlake.llm.shared import chosen, numbered, staged

KEY_BITS = 60
FIRST_BITS = 12
# Blocks the driver refines in one round; with the first level this bounds what it holds.
ROUND_BLOCKS = 1 << 15
# Cells of about equal row counts in which slots are numbered.
CELLS = 1 << 12


def group_key(text: Column) -> Column:
    """The first 60 bits of the text's MD5, -1 for null: equal texts have equal keys."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(-1))


def greedy(ends: list[int], shards: int, capacity: int) -> list[int]:
    """Where each shard ends, as an item index, if every shard takes what still fits.

    ``ends`` are running totals. The list is longer than ``shards`` if that is infeasible.
    """
    cuts: list[int] = []
    at, start = 0, 0
    while at < len(ends):
        reach = bisect_right(ends, start + capacity)
        if reach == at or len(cuts) == shards:
            return [0] * (shards + 1)
        at, start = reach, ends[reach - 1]
        cuts.append(at)
    return cuts


def smallest_capacity(ends: list[int], shards: int, low: int) -> int:
    high = ends[-1]
    while low < high:
        middle = (low + high) // 2
        if len(greedy(ends, shards, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return high


def cut_keys(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """Group keys at which shards 1, 2, ... begin, and the capacity found.

    ``groups`` has one row (key, bytes) for each atomic group. The driver never holds the
    groups: it holds blocks of the key space with their bytes, 4,096 at first. Those that
    a cut of any possible capacity can fall into are split further, at most 32,768 new
    blocks a round, until a cut can only fall between single groups. Coarse blocks
    elsewhere hold no cut, so the search is exact.
    """

    def blocks(bits: int, inside: DataFrame) -> list[tuple]:
        block = F.expr(f"shiftright(key, {KEY_BITS - bits})")
        found = inside.groupBy(block.alias("block")).agg(
            F.sum("bytes"), F.max("bytes"), F.min("key"), F.max("key")
        )
        # first key of the block, bytes, largest group, whether it is a single group
        return [(r[3], r[1], r[2], r[3] == r[4], r[0], bits) for r in found.collect()]

    def refined(own: list[tuple], bits: int) -> list[tuple]:
        step = 1
        while bits + step < KEY_BITS and len(own) << (step + 1) <= ROUND_BLOCKS:
            step += 1
        wanted = groups.sparkSession.createDataFrame([(x[4],) for x in own], "wanted long")
        inside = groups.join(
            F.broadcast(wanted), F.expr(f"shiftright(key, {KEY_BITS - bits}) = wanted"), "left_semi"
        )
        return blocks(bits + step, inside)

    items = sorted(blocks(FIRST_BITS, groups))
    if not items:
        return [], 0
    total, largest = sum(x[1] for x in items), max(x[2] for x in items)
    while True:
        ends = list(accumulate(x[1] for x in items))
        low = max(largest, -(-total // shards))
        high = smallest_capacity(ends, shards, low)
        coarse, earliest, latest = set(), 0, 0
        for j in range(1, shards):
            at = bisect_right(ends, earliest + low)
            earliest = ends[at - 1] if at else 0
            latest = min(total, latest + high)
            inside = bisect_right(ends, latest)
            if inside < len(items) and items[inside][3]:  # no cut falls inside a single group
                latest = ends[inside - 1] if inside else 0
            for i in range(at, min(len(items), bisect_right(ends, latest) + 1)):
                if not items[i][3]:
                    coarse.add(i)
        if not coarse:
            break
        open_items = [items[i] for i in sorted(coarse)]
        finer: list[tuple] = []
        for bits in sorted({x[5] for x in open_items}):
            finer += refined([x for x in open_items if x[5] == bits], bits)
        items = sorted([x for i, x in enumerate(items) if i not in coarse] + finer)
    return [items[i][0] for i in greedy(ends, shards, high)[:-1]], high


def shard_documents(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shards have nearly equal sizes, and equal texts share a shard.
    ``slot`` numbers the rows of a shard from 0 without gaps. ``grown_shard`` is null, as
    it belongs to another law.

    Null texts are one group with size 1 each and a null checksum; empty texts are
    another. Null ids count as 0 when rows are dealt to cells and sort first. Repeated
    rows are all placed, next to each other. An empty table gives no rows. With fewer
    groups than shards the last shards stay empty. Other columns are ignored.
    """
    rows = staged(
        chosen(docs, doc_id=id_col, text=text_col).select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            group_key(F.col("text")).alias("key"),
        ),
        "rows",
    )
    groups = staged(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    cuts, _ = cut_keys(groups, shards)
    shard = F.lit(0)
    for key in cuts:
        shard = shard + (F.col("key") >= key).cast("int")

    # A cell is a range of keys, split by id where one text fills it with its copies.
    cell = F.expr(f"shiftright(key, {KEY_BITS - FIRST_BITS})")
    counts = rows.groupBy(cell.alias("range")).agg(F.count("*").alias("n"))
    fair = F.greatest(F.lit(1), F.sum("n").over(Window.partitionBy(F.lit(0))) / CELLS)
    parts = counts.select("range", F.ceil(F.col("n") / fair).alias("parts"))
    placed = rows.withColumns({"shard": shard, "range": cell}).join(F.broadcast(parts), "range")
    part = F.pmod(F.coalesce("doc_id", F.lit(0)), F.col("parts"))
    return numbered(
        placed, ["shard"], F.struct("range", part.alias("part")),
        [F.col("key"), F.col("doc_id")], F.lit(1).cast("long"), "slot",
    ).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
