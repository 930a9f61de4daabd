"""Registering written tables in the Spark catalog.

A table is listed once when it is registered: schema, layout and days come from that one
listing. Later loads report the days that they wrote, and only these are added.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from chartlake.schemas import EXPORTS
from chartlake.sinks.writers import Days, append_parquet
from chartlake.sources.readers import partition_columns, partition_folders, root_paths
from chartlake.sources.widening import read_widened

# Days that one statement adds.
BATCH_DAYS = 500
# Fixed value: the folder name of a null.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    path: str,
    partition_by: str | None = None,
    files: DataFrame | None = None,
) -> None:
    """Make the Parquet directory at ``path`` an external table of ``database``.

    Files with different columns or types of different width are merged into one schema,
    see ``read_widened``. The days that the listing shows are added; without that the table
    would be empty. Dropping or re-registering the table never touches the files. A table
    that is registered with the same columns and place stays, and only gets its new days.
    ``files`` is a frame over ``path`` that has been listed already.
    """
    files = read_widened(spark, path) if files is None else files
    table = f"`{database}`.`{name}`"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    partitioned = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    if not _registered(spark, database, name, files.dtypes, path):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet {partitioned} LOCATION '{quoted(path)}'"
        )
    if partition_by:
        add_days(spark, database, name, partition_by, _listed_days(files, partition_by))
    spark.catalog.refreshTable(table)


def quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _listed_days(files: DataFrame, partition_by: str) -> list[str | None]:
    """The values of ``partition_by`` among the folders of a listed frame."""
    mark = f"{partition_by}="
    names = [
        unquote(part.removeprefix(mark))
        for folder in partition_folders(files)
        for part in folder.split("/")
        if part.startswith(mark)
    ]
    return [None if n == NULL_DAY else n for n in dict.fromkeys(names)]


def add_days(
    spark: SparkSession, database: str, name: str, partition_by: str, days: Iterable[date | str | None]
) -> int:
    """Add these days to a registered table; the ones it has stay. No folder is listed."""
    listed = list(dict.fromkeys(days))
    for i in range(0, len(listed), BATCH_DAYS):
        specs = " ".join(
            f"PARTITION (`{partition_by}`={'null' if d is None else f"'{quoted(str(d))}'"})"
            for d in listed[i : i + BATCH_DAYS]
        )
        spark.sql(f"ALTER TABLE `{database}`.`{name}` ADD IF NOT EXISTS {specs}")
    return len(listed)


def sync_days(spark: SparkSession, database: str, name: str, partition_by: str, days: Days) -> list:
    """Add the days that a load wrote to its table, if that is registered; returns them."""
    found = days.written()
    table = f"`{database}`.`{name}`"
    if found and spark.catalog.tableExists(table):
        add_days(spark, database, name, partition_by, found)
        spark.catalog.refreshTable(table)
    return found


def append_and_register(
    df: DataFrame, database: str, name: str, path: str, partition_by: str
) -> list[date | None]:
    """Append ``df`` by day to ``path`` and add the days written to its table.

    The table is created with the columns of ``df`` if it is not registered yet; days that
    other jobs wrote are left to ``register_table``. Returns the days written.
    """
    spark, days = df.sparkSession, Days(partition_by)
    append_parquet(days.watch(df), path, partition_by)
    if not spark.catalog.tableExists(f"`{database}`.`{name}`"):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(
            f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet "
            f"PARTITIONED BY (`{partition_by}`) LOCATION '{quoted(path)}'"
        )
    return sync_days(spark, database, name, partition_by, days)


def _registered(spark: SparkSession, database: str, name: str, columns: list, path: str) -> bool:
    if not spark.catalog.tableExists(f"`{database}`.`{name}`"):
        return False
    table = spark.table(f"`{database}`.`{name}`")
    here = [p.removeprefix("file:").rstrip("/") for p in root_paths(table)]
    return sorted(table.dtypes) == sorted(columns) and here == [path.removeprefix("file:").rstrip("/")]


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f"LOCATION '{quoted(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` {place}")


def register_exports(
    spark: SparkSession,
    root: str,
    database: str = "tracks",
    names: Sequence[str] = tuple(EXPORTS),
    partition_by: str = "ranking_date",
    database_location: str | None = None,
) -> list[str]:
    """Register the exported tables under ``root`` and return their full names."""
    create_database(spark, database, database_location)
    for name in names:
        path = f"{root}/{name}"
        files = read_widened(spark, path)
        laid_out = partition_by in partition_columns(files)
        register_table(spark, database, name, path, partition_by if laid_out else None, files)
    return [f"{database}.{name}" for name in names]
