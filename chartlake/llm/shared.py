"""What the operators of this package share: columns by exact name, tables, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartlake.sinks.staging import staged

__all__ = ["chosen", "numbered", "read_table", "staged"]

# Java regular expression of a word: what lies between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


# Rows of a text table that go to Python at once; Spark's default would be 30 MB and more.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after limiting the session's Arrow batches to ``BATCH_ROWS`` rows."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chosen(df: DataFrame, **columns: str) -> DataFrame:
    """``chosen(df, id="doc_id")``: the columns of exactly these names, under new names.

    All other columns go, so names that differ only in case, or that an operator uses
    itself, cannot clash. Of columns with the same name the first is taken.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(old)}").alias(new) for new, old in columns.items()])


def numbered(
    df: DataFrame, group: list[str], cell: Column, order: list[Column], size: Column, name: str
) -> DataFrame:
    """Running total of ``size`` before each row of a group, as column ``name``.

    Rows are ordered by ``cell`` (not null) and then by ``order``. Sizes are summed by
    cell first and only the cells' totals run through one ordered pass a group, so no
    task sorts the rows of more than one cell. Rows equal in ``order`` must be equal.
    """
    cells = df.withColumn("_cell", cell).withColumn("_size", size)
    ahead = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy(*group, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = (
        cells.groupBy(*group, "_cell")
        .agg(F.sum("_size").alias("_total"))
        .withColumn("_first", F.coalesce(F.sum("_total").over(ahead), F.lit(0)))
        .drop("_total")
    )
    return (
        cells.withColumn("_before", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(totals, [*group, "_cell"])
        .withColumn(name, F.col("_first") + F.col("_before"))
        .drop("_cell", "_size", "_before", "_first")
    )
