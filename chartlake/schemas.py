"""Explicit schemas of the landed documents and the names of the tables.

Scanning JSON with one of these skips the inference pass over the whole input and
parses only the listed fields.
"""

from __future__ import annotations

# Field names and types of the landed documents.
RAW_TRACKS = """
    album STRUCT<album_type: STRING, href: STRING, id: STRING, name: STRING,
                 release_date: STRING, total_tracks: BIGINT, uri: STRING>,
    artists ARRAY<STRUCT<href: STRING, id: STRING, name: STRING, type: STRING, uri: STRING>>,
    available_markets ARRAY<STRING>,
    date_ranking STRING,
    disc_number BIGINT,
    duration_ms BIGINT,
    explicit BOOLEAN,
    external_ids STRUCT<isrc: STRING>,
    external_urls STRUCT<spotify: STRING>,
    href STRING,
    id STRING,
    is_local BOOLEAN,
    name STRING,
    popularity BIGINT,
    position BIGINT,
    preview_url STRING,
    track_number BIGINT,
    type STRING,
    uri STRING
"""

RAW_ARTISTS = """
    external_urls STRUCT<spotify: STRING>,
    followers STRUCT<total: BIGINT>,
    genres ARRAY<STRING>,
    href STRING,
    id STRING,
    images ARRAY<STRUCT<height: BIGINT, url: STRING, width: BIGINT>>,
    name STRING,
    popularity BIGINT,
    type STRING,
    uri STRING
"""

TRACK_FEATURES = """
    acousticness FLOAT, analysis_url STRING, danceability FLOAT, duration_ms INT,
    energy FLOAT, id STRING, instrumentalness FLOAT, key INT, liveness FLOAT,
    loudness FLOAT, mode FLOAT, speechiness FLOAT, tempo FLOAT, time_signature INT,
    track_href STRING, type STRING, uri STRING, valence FLOAT
"""

SNAPSHOT_DAILY = "items ARRAY<STRUCT<track: STRUCT<id: STRING>>>"
SNAPSHOT_HISTORY = "tracks ARRAY<STRUCT<url: STRING, added_at: STRING>>"

# Columns of the flat tables, in order.
REF_ARTISTS = [
    "external_urls.spotify", "followers.total", "genres", "href", "id",
    "images.height", "images.url", "images.width", "name", "popularity", "type", "uri",
]
ALBUM_FIELDS = ["href", "id", "name", "release_date", "total_tracks", "uri"]
ARTIST_FIELDS = ["href", "id", "name", "type", "uri"]
REF_TRACKS_OWN = [
    "disc_number", "duration_ms", "explicit", "external_ids.isrc", "external_urls.spotify",
    "href", "id", "is_local", "name", "popularity", "preview_url",
    "track_number", "type", "uri", "position",
]

# Columns of the exported tables.
DIM_ARTIST = ["href", "id", "name", "popularity", "type", "uri"]
DIM_TRACK = [
    "album_name", "album_release_date", "disc_number", "explicit", "id", "name",
    "href", "is_local", "track_number", "type", "uri",
]
TRACK_STATISTICS = [
    "acousticness", "danceability", "duration_ms", "energy", "id",
    "instrumentalness", "liveness", "loudness", "mode", "speechiness", "valence",
    "tempo", "time_signature",
]

# The partition column and the keys that decide what is new.
DAY = "ranking_date"
KEYS = {
    "ref/artists": ["id"],
    "ref/tracks": ["position", "ranking_date"],
    "ref/tracks_features": ["id"],
    "exp/f_artist": ["position", "ranking_date", "id"],
    "exp/f_ranking": ["position", "ranking_date"],
    "exp/f_track_statistics": ["position", "ranking_date"],
}
# Keys under which landed documents replace each other, and the exports.
LANDED_KEYS = {
    "tracks": ["date_ranking", "position"],
    "tracks_features": ["id"],
    "artists": ["id"],
}
EXPORTS = ["dim_artist", "dim_track", "f_artist", "f_genre", "f_ranking", "f_track_statistics"]
