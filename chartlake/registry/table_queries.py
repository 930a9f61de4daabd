"""Tables over several loads: registration, replacement, key bitmaps, buckets, rejects, drift.

Each query writes given tables, or documents made of them, under a new path in the shared
folder, goes through two or more loads and returns what is read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.registry import views as V
from chartlake.registry.base import query
from chartlake.registry.relational_queries import CUT
from chartlake.registry.storage_queries import _FIRST_LOAD, TRACKS, _orders, _orders_by_day, _ORDERS_SQL
from chartlake.schemas import DAY, TRACK_FEATURES
from chartlake.sinks.bitmaps import append_by_bitmap
from chartlake.sinks.bucketed import append_bucketed
from chartlake.sinks.catalog import append_and_register, create_database
from chartlake.sinks.replace import compact, replace_newer, replace_table
from chartlake.sinks.staging import new_path, staged
from chartlake.sinks.writers import append_parquet, write_json
from chartlake.sources.drift import check_drift
from chartlake.sources.readers import read_json, read_parquet, read_parquet_if_exists
from chartlake.sources.rejects import scan_with_rejects
from chartlake.sources.widening import read_widened
from chartlake.streaming.ingest import append_batch, append_new_files


def _database(spark: SparkSession, name: str) -> tuple[str, str]:
    """A database for this kind of query, and a table name of its own."""
    create_database(spark, name, new_path(spark, name))
    return name, f"t_{uuid.uuid4().hex}"


# --- registration -------------------------------------------------------------


@query(
    "sync_new_days",
    f"""
    SELECT CAST(o_orderdate AS DATE) AS ranking_date, count(*) AS row_count,
           CASE WHEN o_orderdate < DATE '{CUT}' THEN 1 ELSE 2 END AS loaded
    FROM orders GROUP BY ALL
    """,
)
def sync_new_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; after each only the days that it wrote are added to the catalog."""
    (database, name), path = _database(spark, "chart_sync"), new_path(spark, "synced")
    orders = _orders_by_day(spark, sf_dir)
    loaded = []
    for load, part in enumerate((F.col(DAY) < CUT, F.col(DAY) >= CUT), 1):
        days = append_and_register(orders.filter(part), database, name, path, DAY)
        loaded += [(d, load) for d in days]
    counts = spark.table(f"{database}.{name}").groupBy(DAY).agg(F.count("*").alias("row_count"))
    return counts.join(spark.createDataFrame(loaded, f"{DAY} DATE, loaded INT"), DAY)


@query(
    "scan_widened",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE)
                ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS o_custkey, o_orderstatus AS batch
    FROM orders
    """,
)
def scan_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders with int and bigint, float and double, and columns that others lack."""
    path, orders = new_path(spark, "mixed"), _orders(spark, sf_dir)
    kinds = {
        "F": [F.col("o_orderkey").cast("int"), F.col("o_totalprice").cast("float"), F.col("o_orderpriority")],
        "O": [F.col("o_orderkey"), F.col("o_totalprice")],
        "P": [F.col("o_custkey"), F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority")],
    }
    for status, columns in kinds.items():
        orders.filter(F.col("o_orderstatus") == status).select(*columns).write.parquet(f"{path}/batch={status}")
    return read_widened(spark, path)


@query(
    "existence_probe",
    """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'P') AS row_count,
           count(*) FILTER (WHERE o_orderstatus = 'P') > 0 AS found
    FROM orders GROUP BY o_orderpriority
    """,
)
def existence_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tables of the open orders of a priority were written, and what they hold."""
    path, orders = new_path(spark, "probed"), _orders(spark, sf_dir)
    orders.filter("o_orderstatus = 'P'").write.partitionBy("o_orderpriority").parquet(path)
    found = []
    for row in orders.select("o_orderpriority").distinct().collect():  # a handful of names
        table = read_parquet_if_exists(spark, f"{path}/o_orderpriority={row[0]}")
        found.append((row[0], 0 if table is None else table.count(), table is not None))
    return spark.createDataFrame(found, "o_orderpriority STRING, row_count BIGINT, found BOOLEAN")


# --- replacement --------------------------------------------------------------


@query(
    "replace_in_place",
    f"""
    WITH runs AS (
        SELECT 1 AS run, id, "position", ranking_date, artists_id FROM {TRACKS}
        UNION ALL
        SELECT 2, id, "position", ranking_date, artists_id + 1000000 FROM {TRACKS}
        WHERE ranking_date >= DATE '{CUT}' AND "position" <= 4
    )
    SELECT * FROM runs QUALIFY row_number() OVER (
        PARTITION BY "position", ranking_date ORDER BY run DESC, id DESC, artists_id DESC) = 1
    """,
)
def replace_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, a later one that replaces places of some days, and the first once more."""
    path = new_path(spark, "replaced")
    places = V.flat_tracks(spark, sf_dir).select(
        F.lit(1).alias("run"), "id", "position", "ranking_date", "artists_id"
    )
    first = staged(places, "run-1")
    later = first.filter(f"ranking_date >= '{CUT}' AND position <= 4").withColumns(
        {"run": F.lit(2), "artists_id": F.col("artists_id") + 1000000}
    )
    for batch in (first, later, first):
        replace_newer(batch, path, ["position", "ranking_date"], ["run", "id", "artists_id"], DAY)
    return read_parquet(spark, path)


@query(
    "replace_from_itself",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal * 4 AS c_acctbal, c_mktsegment
    FROM customer WHERE c_acctbal * 2 > 0
    """,
)
def replace_from_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is rewritten twice by jobs that read it."""
    (database, name), root = _database(spark, "chart_versions"), new_path(spark, "versions")
    replace_table(V.table(spark, sf_dir, "customer"), database, name, root)
    for _ in range(2):
        table = spark.table(f"{database}.{name}")
        doubled = table.filter("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") * 2)
        replace_table(doubled, database, name, root)
    return spark.table(f"{database}.{name}")


_MONTH_SQL = "CAST(date_trunc('month', o_orderdate) AS DATE) AS ranking_date"


@query("compact_days", f"SELECT *, {_MONTH_SQL} FROM ({_ORDERS_SQL})")
def compact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small loads into the same partitions, which are then put together."""
    path = new_path(spark, "scattered")
    orders = _orders(spark, sf_dir).withColumn(DAY, F.trunc("o_orderdate", "month"))
    for priority in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        append_parquet(orders.filter(F.col("o_orderpriority") == priority), path, partition_by=DAY)
    others = orders.filter(
        "o_orderpriority IS NULL OR o_orderpriority NOT IN "
        "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"
    )
    append_parquet(others, path, partition_by=DAY)
    compact(spark, path, DAY, max_files=2)
    return read_parquet(spark, path)


# --- what is known already ----------------------------------------------------


@query(
    "incremental_bitmap",
    f"""
    WITH tracks AS (SELECT id, "position", ranking_date, artists_id FROM {TRACKS}),
         held AS (SELECT * FROM tracks WHERE {_FIRST_LOAD})
    SELECT * FROM held
    UNION ALL
    SELECT t.* FROM tracks t WHERE NOT EXISTS
        (SELECT 1 FROM held h WHERE h."position" = t."position" AND h.ranking_date = t.ranking_date)
    """,
)
def incremental_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of ``incremental_append``, with known places looked up in bitmaps."""
    path = new_path(spark, "by-bitmap")
    tracks = staged(
        V.flat_tracks(spark, sf_dir).select("id", "position", "ranking_date", "artists_id"), "places"
    )
    for batch in (tracks.filter(_FIRST_LOAD.replace('"', "")), tracks, tracks):
        append_by_bitmap(batch, path, "position", DAY)
    return read_parquet(spark, path)


_LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]


@query(
    "incremental_bucketed",
    f"""
    WITH held AS (SELECT {", ".join(_LINES)} FROM lineitem WHERE l_returnflag = 'R')
    SELECT * FROM held
    UNION ALL
    SELECT {", ".join(_LINES)} FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM held)
    """,
)
def incremental_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some orders, then all, then all once more, into a table in buckets of the order."""
    (database, name), path = _database(spark, "chart_buckets"), new_path(spark, "bucketed")
    lines = V.table(spark, sf_dir, "lineitem").select(*_LINES)
    for batch in (lines.filter("l_returnflag = 'R'"), lines, lines):
        append_bucketed(batch, database, name, "l_orderkey", path, buckets=8)
    return spark.table(f"{database}.{name}")


# --- raw records --------------------------------------------------------------


@query(
    "scan_json_rejects",
    f"""
    SELECT id, tempo <= 64 OR time_signature = 0 AS rejected,
           CASE WHEN tempo > 64 AND time_signature <> 0 THEN tempo END AS tempo
    FROM ({V.FEATURE_DOCS_SQL})
    """,
)
def scan_json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines and rejects of a scan with text for a number and lines cut short."""
    docs = V.feature_docs(spark, sf_dir)
    others = [c for c in docs.columns if c not in ("id", "tempo")]
    slow = F.to_json(F.struct("id", F.lit("slow").alias("tempo"), *others))
    line = F.when(F.col("tempo") <= 64, slow).otherwise(F.to_json(F.struct("id", "tempo", *others)))
    cut = F.when(F.col("time_signature") == 0, F.substring(line, 1, 60)).otherwise(line)
    path = new_path(spark, "spoiled")
    docs.select(cut).write.text(path)
    scan = scan_with_rejects(spark, path, TRACK_FEATURES)
    known = F.regexp_extract("record", '"id":"([^"]*)"', 1)
    return scan.good.select("id", F.lit(False).alias("rejected"), "tempo").unionByName(
        scan.rejects.select(
            known.alias("id"), F.lit(True).alias("rejected"), F.lit(None).cast("float").alias("tempo")
        )
    )


@query(
    "schema_drift",
    f"""
    WITH d AS ({V.FEATURE_DOCS_SQL})
    SELECT 'tempo' AS field, 'retyped' AS change, 'decimal' AS before,
           CASE WHEN max(tempo) > 64 THEN 'variant' ELSE 'string' END AS after
    FROM d HAVING min(tempo) <= 64
    UNION ALL SELECT 'unlisted', 'new', NULL, 'list' FROM d HAVING count(*) > 0
    UNION ALL SELECT 'unlisted[]', 'new', NULL, 'bigint' FROM d HAVING count(*) > 0
    UNION ALL SELECT 'valence', 'missing', 'decimal', NULL FROM d HAVING count(*) > 0
    """,
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second landing has that the first had not, lacks, and has of another type."""
    path, stored = new_path(spark, "landings"), new_path(spark, "landed-schema")
    docs = V.feature_docs(spark, sf_dir)
    write_json(docs, f"{path}/1")
    check_drift(spark, f"{path}/1", stored)
    tempo = F.col("tempo")
    changed = docs.drop("valence", "tempo").columns
    listed = F.array("duration_ms").alias("unlisted")
    slow = F.to_json(F.struct(*changed, listed, F.lit("slow").alias("tempo")), {"ignoreNullFields": "false"})
    plain = F.to_json(F.struct(*changed, listed, tempo), {"ignoreNullFields": "false"})
    docs.select(F.when(tempo <= 64, slow).otherwise(plain)).write.text(f"{path}/2")
    return check_drift(spark, f"{path}/2", stored)


_NAMED_SQL = f"""
    SELECT CASE WHEN instrumentalness > 0 THEN id END AS id, analysis_url, duration_ms, "mode"
    FROM ({V.FEATURE_DOCS_SQL})
"""


@query(
    "stream_append",
    f"""
    WITH docs AS ({_NAMED_SQL}), held AS (SELECT * FROM docs WHERE "mode" = 1)
    SELECT * FROM held
    UNION ALL
    SELECT * FROM docs WHERE id IS NULL OR id NOT IN (SELECT id FROM held WHERE id IS NOT NULL)
    """,
)
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of new files, of which the first comes again before the second."""
    source, path, checkpoint = (new_path(spark, n) for n in ("arriving", "streamed", "stream-checkpoint"))
    schema = "id STRING, analysis_url STRING, duration_ms INT, mode FLOAT"
    docs = V.feature_docs(spark, sf_dir).select(
        F.when(F.col("instrumentalness") > 0, F.col("id")).alias("id"), "analysis_url", "duration_ms", "mode"
    )
    write_json(docs.filter("mode = 1"), f"{source}/1")
    append_new_files(spark, f"{source}/*", schema, path, ["id"], checkpoint).awaitTermination()
    append_batch(read_json(spark, f"{source}/1", schema), 0, path, ["id"])
    write_json(docs, f"{source}/2")
    append_new_files(spark, f"{source}/*", schema, path, ["id"], checkpoint).awaitTermination()
    return read_parquet(spark, path).drop("load_batch")
