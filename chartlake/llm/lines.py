"""Lines that stand in several documents, dropped from all but the first of them.

Lines are exploded with their position, normalised and hashed. Distinct documents are
counted by hash; the positions of the lines to drop are gathered by text, and the text is
put together again without them. Whole texts are shuffled once, for that last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.llm.shared import chosen, staged

# The white space stripped from a line, and the letters lower-cased.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAST_CHARS = 10
AT_LEAST = 2


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def hashed_lines(texts: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, text_hash, place, h1, h2) of every line whose key is long enough.

    A key is told by 128 bits of hash.
    """
    lines = texts.select(
        "doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("place", "line")
    ).select("doc_id", "text_hash", "place", line_key(F.col("line")).alias("key"))
    return lines.filter(F.length("key") >= least_chars).select(
        "doc_id", "text_hash", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    at_least: int = AT_LEAST,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (the lines that stay), n_lines, n_dropped.

    Keys of at least ``least_chars`` code points that stand in ``at_least`` or more
    documents lose their lines everywhere except in the smallest id that holds them, which
    keeps all of its own. A document is what one id names: rows of the same id count once
    and keep or lose a line together; rows without an id are one document, after all others.

    A null text counts as empty, and an empty text has one empty line. Lines are never cut.
    An empty table gives no rows. Other columns are ignored.
    """
    texts = (
        chosen(docs, doc_id=id_col, text=text_col)
        .withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("text_hash", F.xxhash64("text"))
    )
    lines = staged(hashed_lines(texts, least_chars), "lines")
    # Counted by (hash, document) first, so a line of every document is no hot group.
    common = staged(
        lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("keeper"))
        .filter(F.col("n") >= at_least)
        .select("h1", "h2", "keeper"),
        "common-lines",
    )
    # Both sides are stored tables, so a partition that one common line fills can be split;
    # the hint keeps this one plan at every size.
    dropped = (
        lines.join(common.hint("merge"), ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("place").alias("gone"))
        .withColumnsRenamed({"doc_id": "gone_id", "text_hash": "gone_hash"})
    )
    same = (F.col("text_hash") == F.col("gone_hash")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    parts = texts.join(dropped.hint("merge"), same, "left").select(
        "doc_id",
        F.split("text", "\n", -1).alias("lines"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return parts.select(
        "doc_id",
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
    )
