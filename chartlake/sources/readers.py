"""Scans. All are lazy and leave pruning and pushdown to the optimizer."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


# Spark lists a table of more than 32 folders in a job of one task a folder, up to this number.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE, MOST_LISTING_TASKS = 4, 10_000


def listing_by_cores(spark: SparkSession) -> SparkSession:
    """``spark``, after limiting its listing jobs to a few tasks a core.

    Folders are dealt evenly to the tasks, so a table of a thousand days is listed in a
    second and not in the ten that a thousand tasks take.
    """
    wanted = min(MOST_LISTING_TASKS, LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    if int(spark.conf.get(LISTING)) > wanted:
        spark.conf.set(LISTING, wanted)
    return spark


# A task sorts and hashes rows many times as large as their compressed bytes. So tables are
# scanned and shuffles dealt in pieces of these sizes, in more of them the larger the input is.
SPLIT, SCAN_SPLIT = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MOST_SHUFFLED, MOST_SCANNED, INPUT_A_PARTITION = 16 << 20, 32 << 20, 4 << 20


def bounded_tasks(df: DataFrame) -> DataFrame:
    """``df``, after limiting the rows of one task of a session's scans and shuffles.

    Run-time planning joins small shuffle partitions but never splits large ones that hold many
    keys, so their number must grow with the input.
    """
    conf = df.sparkSession.conf
    for key, most in ((SPLIT, MOST_SHUFFLED), (SCAN_SPLIT, MOST_SCANNED)):
        if byte_count(conf.get(key)) > most:
            conf.set(key, most)
    read = sum(relation.location().sizeInBytes() for relation in file_relations(df))
    wanted = min(read // INPUT_A_PARTITION, 20_000)
    if wanted > int(conf.get(FIRST_PARTITIONS, None) or conf.get("spark.sql.shuffle.partitions")):
        conf.set(FIRST_PARTITIONS, wanted)
    return df


def byte_count(text: str) -> int:
    """A size as settings have it, such as ``64MB``; -1 stays."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) << (10 * " kmgt".index(unit or " "))


def read_json(
    spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON files.

    ``multi_line`` reads each file as one document (or one array of documents);
    otherwise each line is a document and large files are split. Without ``schema``
    Spark reads the whole input once more to infer it.
    """
    reader = listing_by_cores(spark).read.option("multiLine", multi_line)
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, separator: str = ","
) -> DataFrame:
    """Delimited text with a header row; types are inferred unless given."""
    reader = listing_by_cores(spark).read.option("header", True).option("sep", separator)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(
    spark: SparkSession, path: str, schema: str | None = None, merge_schema: bool = False
) -> DataFrame:
    """Parquet directory; partition folders come back as typed columns, placed last."""
    reader = listing_by_cores(spark).read.option("mergeSchema", merge_schema)
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_parquet_if_exists(
    spark: SparkSession, path: str, schema: str | None = None
) -> DataFrame | None:
    """The table, or ``None`` if nothing has been written there yet.

    Only "no such path" and "no data files" count as not there. Any other failure
    is raised: taking, say, a permission error for an empty target would load
    everything a second time.
    """
    try:
        return read_parquet(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return read_parquet_if_exists(spark, path) is not None


def file_relations(df: DataFrame) -> list:
    """The file-based tables that ``df`` reads, as the planner sees them.

    Taken from the plan, so no file is listed on the Python side.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    scans = [leaf.relation() for leaf in found if leaf.getClass().getSimpleName() == "LogicalRelation"]
    return [scan for scan in scans if scan.getClass().getSimpleName() == "HadoopFsRelation"]


def root_paths(df: DataFrame) -> list[str]:
    """The folders and files that the scans of ``df`` were pointed at."""
    paths = [relation.location().rootPaths() for relation in file_relations(df)]
    return [own.apply(i).toString() for own in paths for i in range(own.size())]


def partition_columns(df: DataFrame) -> list[str]:
    """The columns by whose folders the tables under ``df`` are laid out."""
    return [name for relation in file_relations(df) for name in relation.partitionSchema().fieldNames()]


def partition_folders(df: DataFrame) -> list[str]:
    """The partition folders that the scans of ``df`` found when they were listed."""
    found = []
    for relation in file_relations(df):
        listed = relation.location().partitionSpec().partitions().mkString("\n")
        found += [re.search(r"\],([\w+.-]+:.*)\)$", line)[1] for line in listed.split("\n") if line]
    return found


# The folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_values(df: DataFrame, column: str) -> DataFrame | None:
    """The values of a partition column that ``df`` can hold, from the listing of its folders.

    Filters on partition columns are heeded, others are not, so there can be more values than
    rows have, but never fewer. No file is read. ``None`` if ``df`` does not take the column
    straight from the folders of a single table.
    """
    plan = df.select(column)._jdf.queryExecution().sparkPlan()
    leaves = plan.collectLeaves()
    scan = leaves.head() if leaves.size() == 1 else None
    if scan is None or scan.getClass().getSimpleName() != "FileSourceScanExec":
        return None
    if column not in scan.relation().partitionSchema().fieldNames():
        return None
    if not scan.outputSet().contains(plan.output().head()):
        return None
    # A line a file. Paths are encoded twice in it, as folder names and as a URI.
    files = df.sparkSession._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(
        scan.selectedPartitions().toPartitionArray()
    )
    folder = rf"^path: \S*/{column}=([^/\s]*)/\S*, range: "
    texts = set(re.findall(folder, files.mkString("\n"), re.MULTILINE))
    values = [(None if t == NO_VALUE else unquote(unquote(t)),) for t in sorted(texts)]
    listed = df.sparkSession.createDataFrame(values, f"`{column}` string")
    return listed.select(listed[column].cast(df.schema[column].dataType))
