"""Sources, sinks and the jobs that write tables.

Each query writes a given table, or documents made of it, under a new path in the
shared folder, and returns what is read back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.plans import extras, landing, marts, refine
from chartlake.registry import views as V
from chartlake.registry.base import query
from chartlake.registry.relational_queries import (
    ARTISTS,
    CUT,
    _names,
    f_artist_sql,
    f_genre_sql,
    f_ranking_sql,
    f_track_statistics_sql,
)
from chartlake.schemas import (
    DAY,
    DIM_ARTIST,
    DIM_TRACK,
    RAW_ARTISTS,
    RAW_TRACKS,
    SNAPSHOT_DAILY,
    SNAPSHOT_HISTORY,
    TRACK_FEATURES,
)
from chartlake.sinks.catalog import register_exports
from chartlake.sinks.incremental import incremental_append
from chartlake.sinks.preview import preview_rows, preview_schema
from chartlake.sinks.staging import new_path, scratch, scratch_path, staged
from chartlake.sinks.writers import append_parquet, overwrite_parquet, write_json
from chartlake.sources.readers import read_json, read_parquet

_ORDER = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]
_ORDERS_SQL = f"SELECT {_names(_ORDER)} FROM orders"
_BY_DAY_SQL = f"""
    SELECT {_names(_ORDER)}, CAST(o_orderdate AS DATE) AS ranking_date
    FROM orders
"""
TRACKS = f"({V.FLAT_TRACKS_SQL})"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "orders").select(*_ORDER)


def _orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "orders").select(
        *_ORDER, F.col("o_orderdate").cast("date").alias(DAY)
    )


# --- scans -------------------------------------------------------------------

# Documents of one file that holds an array of them.
ARRAY_DOCS = 1000


def _json_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents, as JSON texts, in arrays of at most ``ARRAY_DOCS``."""
    for batch in batches:
        for first in range(0, batch.num_rows, ARRAY_DOCS):
            listed = ",\n".join(batch.column(0).slice(first, ARRAY_DOCS).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([f"[{listed}]"])], names=["value"])


@query("scan_json_inferred", V.ARTIST_DOCS_SQL)
def scan_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over several lines, many to a file, with the schema inferred."""
    docs = V.artist_docs(spark, sf_dir)
    path = new_path(spark, "artists-json")
    pretty = F.to_json(F.struct(*docs.columns), {"pretty": "true", "ignoreNullFields": "false"})
    arrays = docs.select(pretty.alias("doc")).mapInArrow(_json_arrays, "value string")
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    return refine.flat_artists(read_json(spark, path, multi_line=True))


@query(
    "scan_json_schema",
    f"""
    SELECT * REPLACE (CASE WHEN tempo > 64 THEN tempo END AS tempo,
                      CASE WHEN "mode" = 1 THEN valence END AS valence)
    FROM ({V.FEATURE_DOCS_SQL})
    """,
)
def scan_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed schema over lines with an extra field, a missing one and text for a number."""
    docs = V.feature_docs(spark, sf_dir)
    spoiled = (
        docs.withColumn("unlisted", F.lit("dropped"))
        .withColumn("valence", F.when(F.col("mode") == 1, F.col("valence")))
        .withColumn("slow", F.when(F.col("tempo") <= 64, F.lit("slow")))
    )
    plain = [c for c in spoiled.columns if c not in ("tempo", "slow")]
    as_number = F.to_json(F.struct(*plain, "tempo"))
    as_text = F.to_json(F.struct(*plain, F.col("slow").alias("tempo")))
    path = new_path(spark, "features-json")
    spoiled.select(F.when(F.col("slow").isNull(), as_number).otherwise(as_text)).write.text(path)
    return read_json(spark, path, TRACK_FEATURES)


@query(
    "scan_parquet",
    "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem",
)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("scan_parquet_schema", "SELECT * FROM lineitem")
def scan_parquet_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = """
        l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING,
        l_linestatus STRING, l_shipdate TIMESTAMP_NTZ
    """
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet", schema)


@query("scan_partitioned", _BY_DAY_SQL)
def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day is only in the folder names and comes back as a date."""
    path = new_path(spark, "orders-by-day")
    append_parquet(_orders_by_day(spark, sf_dir), path, partition_by=DAY)
    return read_parquet(spark, path)


@query(
    "csv_to_parquet",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = new_path(spark, "customer-csv"), new_path(spark, "customer")
    V.table(spark, sf_dir, "customer").write.option("header", True).csv(source)
    extras.csv_to_parquet(spark, source, path, show=False)
    # Inference gives the narrowest type that fits, so the key is an int or a bigint.
    return read_parquet(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


# --- sinks -------------------------------------------------------------------


@query("sink_overwrite", _ORDERS_SQL)
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "overwritten")
    overwrite_parquet(V.table(spark, sf_dir, "customer"), path)
    overwrite_parquet(_orders(spark, sf_dir), path)
    return read_parquet(spark, path)


@query("sink_append", f"{_ORDERS_SQL} UNION ALL {_ORDERS_SQL} WHERE o_orderstatus = 'F'")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, orders = new_path(spark, "appended"), _orders(spark, sf_dir)
    append_parquet(orders, path)
    append_parquet(orders.filter("o_orderstatus = 'F'"), path)
    return read_parquet(spark, path)


@query("sink_partitioned", f"{_BY_DAY_SQL} UNION ALL {_BY_DAY_SQL} WHERE o_orderstatus = 'F'")
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, orders = new_path(spark, "appended-by-day"), _orders_by_day(spark, sf_dir)
    append_parquet(orders, path, partition_by=DAY)
    append_parquet(orders.filter("o_orderstatus = 'F'"), path, partition_by=DAY)
    return read_parquet(spark, path)


@query("preview", f"{_ORDERS_SQL} ORDER BY o_orderkey LIMIT 20")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_rows(_orders(spark, sf_dir), 20, order_by=["o_orderkey"])


@query(
    "preview_schema",
    """
    SELECT CAST(column_index AS INTEGER) AS place, column_name AS "name",
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
                WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' ELSE 'timestamp_ntz' END AS "type"
    FROM duckdb_columns() WHERE table_name = 'lineitem'
    """,
)
def preview_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_schema(V.table(spark, sf_dir, "lineitem"))


_FIRST_LOAD = f"ranking_date < DATE '{CUT}' AND \"position\" <= 4"


@query(
    "incremental_append",
    f"""
    WITH tracks AS (SELECT id, "position", ranking_date, artists_id FROM {TRACKS}),
         held AS (SELECT * FROM tracks WHERE {_FIRST_LOAD})
    SELECT * FROM held
    UNION ALL
    SELECT t.* FROM tracks t WHERE NOT EXISTS
        (SELECT 1 FROM held h WHERE h."position" = t."position" AND h.ranking_date = t.ranking_date)
    """,
)
def incremental_append_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, then everything, then everything once more: the last adds nothing."""
    path = new_path(spark, "incremental")
    tracks = staged(
        V.flat_tracks(spark, sf_dir).select("id", "position", "ranking_date", "artists_id"),
        "places",
    )
    for batch in (tracks.filter(_FIRST_LOAD.replace('"', "")), tracks, tracks):
        incremental_append(batch, path, ["position", "ranking_date"], partition_by=DAY)
    return read_parquet(spark, path)


@query(
    "catalog_register",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql})"
        for name, sql in {
            "dim_artist": f"SELECT DISTINCT {_names(DIM_ARTIST)} FROM {ARTISTS}",
            "dim_track": f"SELECT DISTINCT {_names(DIM_TRACK)} FROM {TRACKS}",
            "f_artist": f_artist_sql(TRACKS),
            "f_genre": f_genre_sql(TRACKS),
            "f_ranking": f_ranking_sql(TRACKS),
            "f_track_statistics": f_track_statistics_sql(TRACKS),
        }.items()
    ),
)
def catalog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write and register all exports, then count their rows through the catalog."""
    root = new_path(spark, "exports")
    artists = staged(V.flat_artists(spark, sf_dir), "ref-artists")
    tracks = staged(V.flat_tracks(spark, sf_dir), "ref-tracks")
    features = V.flat_features(spark, sf_dir)
    overwrite_parquet(marts.dim_artist(artists), f"{root}/dim_artist")
    overwrite_parquet(marts.dim_track(tracks), f"{root}/dim_track")
    overwrite_parquet(marts.f_genre(artists, tracks), f"{root}/f_genre")
    marts.load_f_artist(artists, tracks, f"{root}/f_artist")
    marts.load_f_ranking(tracks, f"{root}/f_ranking")
    marts.load_f_track_statistics(tracks, features, f"{root}/f_track_statistics")
    names = register_exports(
        spark, root, "chart_exports", database_location=new_path(spark, "database")
    )
    counts = [
        f"SELECT '{name.split('.')[1]}' AS table_name, count(*) AS row_count FROM {name}"
        for name in names
    ]
    return spark.sql(" UNION ALL ".join(counts))


FACTS = {
    "f_artist": f_artist_sql, "f_ranking": f_ranking_sql, "f_track_statistics": f_track_statistics_sql,
}


def _loads(spark: SparkSession, sf_dir: str, load: Callable[[DataFrame, str], None]) -> DataFrame:
    """Some chart places first, then all, then all once more; the last load adds nothing."""
    path = new_path(spark, "fact")
    tracks = staged(V.flat_tracks(spark, sf_dir), "ref-tracks")
    for part in (tracks.filter(_FIRST_LOAD.replace('"', "")), tracks, tracks):
        load(part, path)
    return read_parquet(spark, path)


def _twice_sql(fact: str) -> str:
    """The places of the early load as they were then, the others as they are now."""
    early = f"(SELECT * FROM {TRACKS} WHERE {_FIRST_LOAD})"
    same = 'h."position" = n."position" AND h.ranking_date = n.ranking_date'
    return f"""
    WITH held AS ({FACTS[fact](early)}), now AS ({FACTS[fact](TRACKS)})
    SELECT * FROM held
    UNION ALL
    SELECT n.* FROM now n WHERE NOT EXISTS
        (SELECT 1 FROM held h WHERE {same}{" AND h.id = n.id" if fact == "f_artist" else ""})
    """


@query("load_f_artist", _twice_sql("f_artist"))
def load_f_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = staged(V.flat_artists(spark, sf_dir), "ref-artists")
    return _loads(spark, sf_dir, lambda tracks, path: marts.load_f_artist(artists, tracks, path))


@query("load_f_ranking", _twice_sql("f_ranking"))
def load_f_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loads(spark, sf_dir, marts.load_f_ranking)


@query("load_f_track_statistics", _twice_sql("f_track_statistics"))
def load_f_track_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = V.flat_features(spark, sf_dir)
    return _loads(
        spark, sf_dir, lambda tracks, path: marts.load_f_track_statistics(tracks, features, path)
    )


# --- loads -------------------------------------------------------------------


@query("ref_artists", V.ARTIST_DOCS_SQL)
def ref_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land artist documents in two runs, refining after each; the second repeats the first."""
    raw, path = new_path(spark, "raw-artists"), new_path(spark, "ref-artists")
    docs = V.artist_docs(spark, sf_dir)
    for run, landed in (("1", docs.filter("popularity < 12")), ("2", docs)):
        write_json(landed, f"{raw}/artists/run={run}")
        landed_docs = landing.landed_documents(spark, raw, "artists", RAW_ARTISTS)
        refine.load_artists(landed_docs, path, run="run")
    return read_parquet(spark, path)


_TRACK_COLUMNS = """
    album_type, album_href, album_id, album_name, album_release_date, album_total_tracks,
    album_uri, disc_number, duration_ms, explicit, isrc, spotify, href, id, is_local, "name",
    popularity, preview_url, track_number, "type", uri, "position", ranking_date
"""


@query(
    "ref_tracks",
    f"""
    WITH docs AS ({V.TRACK_DOCS_SQL})
    SELECT {_TRACK_COLUMNS},
           {V.ARTIST_ID_SQL} AS artists_id, {V.ARTIST_NAME_SQL} AS artists_name,
           'artist' AS artists_type, '{V.SITE}/artists/' || {V.ARTIST_ID_SQL} AS artists_href,
           'chart:artist:' || {V.ARTIST_ID_SQL} AS artists_uri
    FROM docs, {V.DOC_ARTISTS_SQL}, {V.DOC_MARKETS_SQL}
    WHERE {V.HAS_ARTIST_SQL} AND {V.HAS_MARKET_SQL}
      AND (ranking_date < DATE '{CUT}' AND "position" <= 4 OR NOT EXISTS
           (SELECT 1 FROM docs h WHERE h.ranking_date < DATE '{CUT}' AND h."position" <= 4
              AND h.l_tax > 0 AND h.l_quantity >= 5
              AND h."position" = docs."position" AND h.ranking_date = docs.ranking_date))
    """,
)
def ref_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the early half of the entry documents, then all of them."""
    raw, path = new_path(spark, "raw-tracks"), new_path(spark, "ref-tracks")
    by_day = V.track_docs(spark, sf_dir, by_day=True)
    write_json(by_day, raw, partition_by="date_ranking", rebalance=False)
    docs = read_json(spark, raw, RAW_TRACKS)
    refine.load_tracks(docs.filter(f"date_ranking < '{CUT}' AND position <= 4"), path)
    refine.load_tracks(docs, path)
    return read_parquet(spark, path)


@query("ref_tracks_features", V.FEATURE_DOCS_SQL)
def ref_tracks_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, path = new_path(spark, "raw-features"), new_path(spark, "ref-features")
    docs = V.feature_docs(spark, sf_dir)
    for run, landed in (("1", docs.filter("mode = 1")), ("2", docs)):
        write_json(landed, f"{raw}/tracks_features/run={run}")
        landed_docs = landing.landed_documents(spark, raw, "tracks_features", TRACK_FEATURES)
        refine.load_track_features(landed_docs, path, run="run")
    return read_parquet(spark, path, TRACK_FEATURES)


# --- landing -----------------------------------------------------------------


_SNAPSHOT_KEYS = "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT"


def _through_json(spark: SparkSession, snapshots: DataFrame, schema: str) -> DataFrame:
    """The snapshots as the jobs find them: JSON documents, read with their fixed schema."""
    path = scratch_path(spark, "snapshots")
    write_json(snapshots, path)
    return read_json(spark, path, schema)


def _land(
    spark: SparkSession,
    sf_dir: str,
    read_snapshots: Callable[[], DataFrame],
    entries: Callable[[DataFrame], DataFrame],
    order: list[str],
) -> DataFrame:
    """Land, read back, and list what lies under which key.

    Nothing is kept longer than it is needed: the JSON of the snapshots goes when they are staged,
    the staged ones when the documents to land are known, and these tables when all is landed. A
    snapshot here lists a few tracks, so it is staged as it is and ranked in each reading.
    """
    root = new_path(spark, "raw")
    with scratch(spark):
        with scratch(spark) as keep:
            with scratch(spark) as keep_snapshots:
                snapshots = keep_snapshots(staged(read_snapshots(), "snapshots-read"))
            landed = landing.land_entries(
                entries(snapshots),
                V.lookup_tracks(spark, sf_dir),
                V.lookup_features(spark, sf_dir),
                V.lookup_artists(spark, sf_dir),
                order,
            )
            landed = landing.Landed(*map(keep, landed))
        landing.write_landed(landed, root, "1")

    def read(kind: str, schema: str, key: Column, name: str, number: str) -> DataFrame:
        return landing.read_landed(spark, root, kind, schema).select(
            key.alias("landed_key"), "id", F.col(name).alias("name"), "uri",
            F.col(number).cast("bigint").alias("number"),
        )

    by_place = landing.tracks_key(F.col("date_ranking"), F.col("position"))
    tracks = read("tracks", RAW_TRACKS, by_place, "name", "popularity")
    features = read(
        "tracks_features", TRACK_FEATURES, landing.record_key("tracks_features", F.col("id")),
        "analysis_url", "duration_ms",
    )
    artists = read(
        "artists", RAW_ARTISTS, landing.record_key("artists", F.col("id")), "name", "popularity"
    )
    return tracks.unionByName(features).unionByName(artists)


def _landed_sql(entries: str, order: str) -> str:
    return f"""
    WITH entries AS ({entries}),
         known AS (SELECT * FROM entries JOIN orders ON track = o_orderkey),
         placed AS (SELECT * FROM known QUALIFY row_number() OVER
                    (PARTITION BY "day", "position" ORDER BY {order},
                     l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                     CAST(track AS VARCHAR) DESC) = 1)
    SELECT 'tracks/musica' || "day" || "position" || '.json' AS landed_key,
           CAST(track AS VARCHAR) AS id, 'Track ' || track AS "name",
           'chart:track:' || track AS uri, CAST(o_custkey % 100 AS BIGINT) AS number
    FROM placed
    UNION ALL
    SELECT DISTINCT 'tracks_features/' || track || '.json', CAST(track AS VARCHAR),
           '{V.SITE}/analysis/' || track, 'chart:track:' || track, CAST(o_custkey * 10 AS BIGINT)
    FROM known WHERE o_orderpriority <> '5-LOW'
    UNION ALL
    SELECT DISTINCT 'artists/C' || c_custkey || '.json', 'C' || c_custkey, c_name,
           'chart:artist:C' || c_custkey, CAST(c_nationkey AS BIGINT)
    FROM known, (VALUES (0), (1)) AS artist(n), customer
    WHERE (artist.n = 0 OR o_orderstatus = 'P') AND c_custkey = o_custkey + artist.n
    """


_LISTED = "CASE item.n WHEN 1 THEN l_orderkey WHEN 2 THEN l_partkey ELSE l_suppkey END AS track"


@query(
    "land_daily",
    _landed_sql(
        f"""
        SELECT lineitem.*, {_LISTED},
               l_shipdate + to_hours(l_linenumber) AS taken_at,
               strftime(taken_at, '%Y-%m-%d') AS "day",
               CASE WHEN item.n = 3 AND l_returnflag = 'R' THEN 4 ELSE item.n END AS "position"
        FROM lineitem, (VALUES (1), (2), (3)) AS item(n)
        """,
        "taken_at DESC",
    ),
)
def land_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    def snapshots() -> DataFrame:
        return _through_json(
            spark,
            V.daily_snapshots(spark, sf_dir),
            f"{SNAPSHOT_DAILY}, {_SNAPSHOT_KEYS}, taken_at TIMESTAMP_NTZ",
        )

    def entries(taken: DataFrame) -> DataFrame:
        return landing.daily_entries(taken, "taken_at")

    return _land(spark, sf_dir, snapshots, entries, ["taken_at", *V.SNAPSHOT_ORDER])


HISTORY_RANGES = [("1990-01-01", "1996-12-31"), ("1997-02-01", "2010-12-31")]


@query(
    "land_history",
    _landed_sql(
        f"""
        SELECT lineitem.*, {_LISTED}, item.n AS "position",
               strftime(l_shipdate + to_days(CASE item.n WHEN 1 THEN 0 WHEN 2 THEN l_linenumber
                                             ELSE 2 END), '%Y-%m-%d') AS "day"
        FROM lineitem, (VALUES (1), (2), (3)) AS item(n)
        WHERE """
        + " OR ".join(
            f"CAST(l_shipdate AS DATE) BETWEEN '{lo}' AND '{hi}'" for lo, hi in HISTORY_RANGES
        ),
        "l_shipdate DESC",
    ),
)
def land_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    def snapshots() -> DataFrame:
        archived = _through_json(
            spark,
            V.history_snapshots(spark, sf_dir),
            f"{SNAPSHOT_HISTORY}, {_SNAPSHOT_KEYS}, snapshot_day TIMESTAMP_NTZ",
        )
        return landing.in_ranges(archived, "snapshot_day", HISTORY_RANGES)

    return _land(
        spark, sf_dir, snapshots, landing.history_entries, ["snapshot_day", *V.SNAPSHOT_ORDER]
    )
