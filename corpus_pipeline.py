"""From raw documents to sharded training text, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read back
as the next stage's documents. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlake.llm.decontamination import decontaminate
from chartlake.llm.mixing import mixed_sizes
from chartlake.llm.ngram_join import ngram_join
from chartlake.llm.quality import reject_poor
from chartlake.llm.shared import read_table, staged
from chartlake.llm.sharding import shard_documents
from chartlake.sinks.staging import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, with all their columns.

    Each row is judged by its own text; null and empty texts are judged like any other.
    Repeated rows are judged alike and stay together. Without documents there is nothing
    to judge; without usable labels all stay.
    """
    return reject_poor(docs, read_table(spark, sf_dir, "labels"))


def keyed(docs: DataFrame) -> tuple[DataFrame, list[str], str]:
    """``docs`` under positional names and with a key for each row, those names, the key's.

    The key is made of the row's stored place: where the keys of its file start, and its
    number in the file. The starts are hashes of the file paths, checked to lie so far apart
    that no two rows share a key. So it is the same in every read, and no document is
    stored once more; only documents that are not read straight from files are.
    """
    try:
        place = docs.metadataColumn("_metadata")
    except AnalysisException:
        docs = staged(docs, "documents")
        place = docs.metadataColumn("_metadata")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.select("*", place["file_path"], place["row_index"]).toDF(*names, "file", "place")
    files = staged(plain.groupBy("file").agg((F.max("place") + 1).alias("n")), "files")
    for salt in range(8):
        start = F.xxhash64(F.lit(salt), "file").bitwiseAND(F.lit((1 << 62) - 1))
        following = F.lead("start").over(Window.orderBy("start"))
        apart = files.withColumn("start", start).withColumn("following", following)
        if apart.filter("start + n > following").isEmpty():
            break
    else:
        raise ValueError("no hash keeps the files' rows apart")
    return plain.withColumn("row_key", start + F.col("place")).drop("file", "place"), names, "row_key"


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: the one with the smallest id.

    Similar: five-word shingles, Jaccard similarity of 0.8 or more. Of rows with the same
    id one stays; a row without an id stays only if no row of its component has one. Null,
    empty and wordless texts are similar to nothing and stay, repeats included. An empty
    table gives none.
    """
    with scratch(spark) as keep:
        rows, names, key = keyed(docs)
        id_of, text_of = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
        similar = ngram_join(rows, id_col=key, text_col=text_of, words=5, percent=80)
        found = staged(
            similar.select(F.col("doc_id").alias(key), "component_id")
            .join(rows.select(key, F.col(id_of).alias("id")), key),
            "similar",
        )
        first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", key))[key]
        kept = found.groupBy("component_id").agg(first.alias(key)).select(key)
        dropped = staged(found.select(key).join(kept, key, "left_anti"), "dropped")
        return keep(rows.join(dropped, key, "left_anti").select(*names).toDF(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item, each row judged by its own text.

    Null and wordless texts hold nothing and stay. An empty benchmark leaves all.
    """
    with scratch(spark) as keep:
        rows, names, key = keyed(docs)
        text_of = names[docs.columns.index("text")]
        found = decontaminate(rows, read_table(spark, sf_dir, "benchmark"), id_col=key, text_col=text_of)
        hit = staged(found.filter("contaminated").select(F.col("doc_id").alias(key)), "contaminated")
        return keep(rows.join(hit, key, "left_anti").select(*names).toDF(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words: 0, 1 or 2 times.

    Each row is decided on its own, whatever its id; rows are ordered by a hash of id, text
    and source, so reruns over other files agree up to rows equal in these. The fraction of a
    document's words left over is rounded up for a share of the rows that this hash decides,
    so the words of a source come near its target. Documents without words, null texts among
    them, are nothing that a mix could take and go.
    """
    with scratch(spark) as keep:
        rows, names, key = keyed(docs)
        id_of, text_of, source_of = (names[docs.columns.index(c)] for c in ("doc_id", "text", "source"))
        content = rows.withColumn("content", F.xxhash64(id_of, text_of, source_of))
        sizes = mixed_sizes(content, id_col="content", text_col=text_of, source_col=source_of, key_col=key)
        part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
        times = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + part).cast("int")
        taken = staged(sizes.select(F.col("key").alias(key), times.alias("times")).filter("times > 0"), "times")
        copies = F.explode(F.array_repeat(F.lit(True), F.col("times")))
        # The hint keeps one plan at every size.
        mixed = rows.join(taken.hint("merge"), key).withColumn("copy", copies)
        return keep(mixed.select(*names).toDF(*docs.columns))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes; equal texts share a shard.

    One row per document, repeats included, with its shard and its slot there; null texts
    are one group. An empty table gives no rows.
    """
    return shard_documents(docs, shards=16)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_similar),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The quality classifier cannot be written as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
