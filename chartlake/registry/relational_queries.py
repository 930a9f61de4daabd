"""Projections, joins, aggregates and the marts over the flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.operators.aggregates import (
    distinct_projection,
    group_concat,
    group_count,
    latest_by_key,
)
from chartlake.operators.joins import enrich, inner_renamed, unseen
from chartlake.operators.projections import prefixed
from chartlake.plans import marts
from chartlake.registry import views as V
from chartlake.registry.base import query
from chartlake.schemas import DIM_ARTIST, DIM_TRACK, TRACK_STATISTICS

TRACKS = f"({V.FLAT_TRACKS_SQL})"
ARTISTS = f"({V.FLAT_ARTISTS_SQL})"
FEATURES = f"({V.FLAT_FEATURES_SQL})"
CUT = "1998-01-01"


def _names(columns: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


@query("project_columns", f"SELECT {_names(DIM_TRACK)} FROM {TRACKS}")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.flat_tracks(spark, sf_dir).select(*DIM_TRACK)


@query("distinct_projection", f"SELECT DISTINCT artists_id, ranking_date FROM {TRACKS}")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_projection(V.flat_tracks(spark, sf_dir), ["artists_id", "ranking_date"])


@query(
    "distinct_after_join",
    f"""
    SELECT DISTINCT t.artists_id, t.ranking_date, f.energy, f.tempo
    FROM {TRACKS} t JOIN {FEATURES} f ON t.id = f.id
    """,
)
def distinct_after_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = V.flat_features(spark, sf_dir).select(
        F.col("id").alias("features_id"), "energy", "tempo"
    )
    joined = inner_renamed(V.flat_tracks(spark, sf_dir), features, "id", "features_id")
    return distinct_projection(joined, ["artists_id", "ranking_date", "energy", "tempo"])


@query(
    "group_count",
    f'SELECT artists_id, ranking_date, count(*) AS "count" FROM {TRACKS} GROUP BY ALL',
)
def group_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(V.flat_tracks(spark, sf_dir), ["artists_id", "ranking_date"])


@query(
    "group_concat",
    f"""
    SELECT id, total, string_agg(genres, ', ' ORDER BY genres) AS genres
    FROM (SELECT DISTINCT id, total, genres FROM {ARTISTS}) GROUP BY id, total
    """,
)
def group_concat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_concat(V.flat_artists(spark, sf_dir), ["id", "total"], "genres", "genres")


@query(
    "join_inner_renamed",
    f"""
    SELECT a.id, a.genres, t.artists_id, t."position", t.ranking_date
    FROM (SELECT DISTINCT id, genres FROM {ARTISTS}) a JOIN {TRACKS} t ON a.id = t.artists_id
    """,
)
def join_inner_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = distinct_projection(V.flat_artists(spark, sf_dir), ["id", "genres"])
    places = V.flat_tracks(spark, sf_dir).select("artists_id", "position", "ranking_date")
    return inner_renamed(artists, places, "id", "artists_id")


@query(
    "anti_join_one_key",
    f"SELECT f.* FROM {FEATURES} f WHERE NOT EXISTS (SELECT 1 FROM {TRACKS} t WHERE t.id = f.id)",
)
def anti_join_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return unseen(V.flat_features(spark, sf_dir), lines, ["id"])


_ENTRY = 'id, "position", ranking_date, artists_id'


@query(
    "anti_join_two_keys",
    f"""
    SELECT {_ENTRY} FROM {TRACKS} t WHERE NOT EXISTS
        (SELECT 1 FROM {TRACKS} o WHERE o.ranking_date < DATE '{CUT}'
         AND o."position" = t."position" AND o.ranking_date = t.ranking_date)
    """,
)
def anti_join_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = V.flat_tracks(spark, sf_dir).select("id", "position", "ranking_date", "artists_id")
    target = tracks.filter(F.col("ranking_date") < F.lit(CUT).cast("date"))
    return unseen(tracks, target, ["position", "ranking_date"])


@query(
    "anti_join_three_keys",
    f"""
    SELECT {_ENTRY} FROM {TRACKS} t WHERE NOT EXISTS
        (SELECT 1 FROM {TRACKS} o WHERE o.ranking_date < DATE '{CUT}' AND o."position" <= 4
         AND o."position" = t."position" AND o.ranking_date = t.ranking_date AND o.id = t.id)
    """,
)
def anti_join_three_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = V.flat_tracks(spark, sf_dir).select("id", "position", "ranking_date", "artists_id")
    target = tracks.filter(
        (F.col("ranking_date") < F.lit(CUT).cast("date")) & (F.col("position") <= 4)
    )
    return unseen(tracks, target, ["position", "ranking_date", "id"])


@query(
    "latest_by_key",
    """
    SELECT event_id, user_id, event_type, ts, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest_by_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.table(spark, sf_dir, "events")
    return latest_by_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "enrich_lookup",
    """
    SELECT l_linenumber AS "position", 'Track ' || o_orderkey AS track_name,
           CAST(o_totalprice AS FLOAT) AS energy, c_name AS artist_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey,
         (VALUES (0), (1)) AS artist(n), customer
    WHERE (artist.n = 0 OR o_orderstatus = 'P') AND c_custkey = o_custkey + artist.n
      AND o_orderpriority <> '5-LOW'
    """,
)
def enrich_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("track_id"),
        F.col("l_linenumber").alias("position"),
    )
    tracks = V.lookup_tracks(spark, sf_dir).select("id", "name", "artists")
    features = V.lookup_features(spark, sf_dir).select("id", "energy")
    artists = V.lookup_artists(spark, sf_dir).select("id", "name")

    named = enrich(entries, tracks, "track_id").select(
        "position", "track_id", *prefixed("record", ["name", "artists"], prefix="track")
    )
    measured = enrich(named, features, "track_id").select(
        "position",
        "track_name",
        F.col("record.energy").alias("energy"),
        F.explode("track_artists.id").alias("artist_id"),
    )
    return enrich(measured, artists, "artist_id").select(
        "position", "track_name", "energy", F.col("record.name").alias("artist_name")
    )


_NULL_TRACKS = f"""
    SELECT CASE WHEN id % 7 <> 0 THEN id END AS id, "position",
           CASE WHEN id % 5 <> 0 THEN ranking_date END AS ranking_date, artists_id FROM {TRACKS}
"""


def _null_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart places of which some have no day and some no track."""
    return V.flat_tracks(spark, sf_dir).select(
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"),
        "position",
        F.when(F.col("id") % 5 != 0, F.col("ranking_date")).alias("ranking_date"),
        "artists_id",
    )


@query(
    "anti_join_null_keys",
    f"""
    WITH t AS ({_NULL_TRACKS})
    SELECT * FROM t WHERE NOT EXISTS
        (SELECT 1 FROM t o WHERE o."position" <= 4 AND o."position" = t."position"
         AND o.ranking_date = t.ranking_date)
    """,
)
def anti_join_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = _null_tracks(spark, sf_dir)
    return unseen(tracks, tracks.filter("position <= 4"), ["position", "ranking_date"])


@query(
    "anti_join_null_safe",
    f"""
    WITH t AS ({_NULL_TRACKS})
    SELECT * FROM t WHERE NOT EXISTS
        (SELECT 1 FROM t o WHERE o."position" <= 4 AND o."position" = t."position"
         AND o.ranking_date IS NOT DISTINCT FROM t.ranking_date)
    """,
)
def anti_join_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = _null_tracks(spark, sf_dir)
    return unseen(
        tracks, tracks.filter("position <= 4"), ["position", "ranking_date"], null_safe=True
    )


@query(
    "join_null_keys",
    f"""
    WITH t AS ({_NULL_TRACKS})
    SELECT t.id, t."position", t.ranking_date, f.features_id, f.energy
    FROM t JOIN (SELECT CASE WHEN id % 3 <> 0 THEN id END AS features_id, energy FROM {FEATURES}) f
      ON t.id = f.features_id
    """,
)
def join_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = V.flat_features(spark, sf_dir).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("features_id"), "energy"
    )
    places = _null_tracks(spark, sf_dir).select("id", "position", "ranking_date")
    return inner_renamed(places, features, "id", "features_id")


@query(
    "latest_by_key_null_keys",
    """
    WITH e AS (SELECT * REPLACE (CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id) FROM events)
    SELECT * FROM e WHERE user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    UNION ALL
    SELECT * FROM e WHERE user_id IS NULL
    """,
)
def latest_by_key_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.table(spark, sf_dir, "events").withColumn(
        "user_id", F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    )
    return latest_by_key(events, ["user_id", "event_type"], ["ts", "event_id"])


# --- marts -------------------------------------------------------------------


@query("dim_artist", f"SELECT DISTINCT {_names(DIM_ARTIST)} FROM {ARTISTS}")
def dim_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_artist(V.flat_artists(spark, sf_dir))


@query("dim_track", f"SELECT DISTINCT {_names(DIM_TRACK)} FROM {TRACKS}")
def dim_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_track(V.flat_tracks(spark, sf_dir))


def f_artist_sql(tracks: str) -> str:
    return f"""
    SELECT a.id, a.total, a.genres, t.ranking_date, t.artists_id, t."position"
    FROM (SELECT id, total, string_agg(genres, ', ' ORDER BY genres) AS genres
          FROM (SELECT DISTINCT id, total, genres FROM {ARTISTS}) GROUP BY id, total) a
    JOIN {tracks} t ON a.id = t.artists_id
    """


def f_genre_sql(tracks: str) -> str:
    return f"""
    SELECT a.genres AS genre, t.ranking_date, count(*) AS "count"
    FROM (SELECT DISTINCT id, artists_id, ranking_date FROM {tracks}) t
    JOIN (SELECT DISTINCT id, genres FROM {ARTISTS}) a ON a.id = t.artists_id
    GROUP BY ALL
    """


def f_ranking_sql(tracks: str) -> str:
    return f"""
    SELECT id, ranking_date, "position",
           string_agg(artists_name, ', ' ORDER BY artists_name) AS artist
    FROM (SELECT DISTINCT id, ranking_date, "position", artists_name FROM {tracks}) GROUP BY ALL
    """


def f_track_statistics_sql(tracks: str) -> str:
    return f"""
    SELECT DISTINCT {", ".join(f'f."{c}"' for c in TRACK_STATISTICS)},
           t.ranking_date, t.id AS track_id, t."position"
    FROM {FEATURES} f JOIN {tracks} t ON t.id = f.id
    """


@query("f_artist", f_artist_sql(TRACKS))
def f_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.f_artist(V.flat_artists(spark, sf_dir), V.flat_tracks(spark, sf_dir))


@query("f_genre", f_genre_sql(TRACKS))
def f_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.f_genre(V.flat_artists(spark, sf_dir), V.flat_tracks(spark, sf_dir))


@query("f_ranking", f_ranking_sql(TRACKS))
def f_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.f_ranking(V.flat_tracks(spark, sf_dir))


@query("f_track_statistics", f_track_statistics_sql(TRACKS))
def f_track_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.f_track_statistics(V.flat_tracks(spark, sf_dir), V.flat_features(spark, sf_dir))
