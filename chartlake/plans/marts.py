"""Flat tables to dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.operators.aggregates import distinct_projection, group_concat, group_count
from chartlake.operators.joins import inner_renamed
from chartlake.schemas import DAY, DIM_ARTIST, DIM_TRACK, KEYS, TRACK_STATISTICS
from chartlake.sinks.incremental import incremental_append
from chartlake.sinks.staging import staged
from chartlake.sinks.writers import Days


def dim_artist(artists: DataFrame) -> DataFrame:
    return distinct_projection(artists, DIM_ARTIST)


def dim_track(tracks: DataFrame) -> DataFrame:
    return distinct_projection(tracks, DIM_TRACK)


def f_artist(artists: DataFrame, tracks: DataFrame) -> DataFrame:
    """Genres and follower total of the artist at every chart place.

    Copies in ``tracks`` are kept. An artist with two follower totals gives two rows
    per place.

    The artists, one row each, are written once. The size of that table is known before
    the join is planned: if it is small it is broadcast, and the far larger ``tracks`` is
    not shuffled.
    """
    genres = staged(group_concat(artists, ["id", "total"], "genres", "genres"), "artist-genres")
    places = tracks.select(DAY, "artists_id", "position")
    return inner_renamed(genres, places, "id", "artists_id")


def f_genre(artists: DataFrame, tracks: DataFrame) -> DataFrame:
    """Number of (track, artist) pairs per genre and day.

    The pairs are counted per artist and day *before* the join and the counts added
    after it: the join then sees one row per artist and day, however many tracks a
    popular artist has.
    """
    pairs = distinct_projection(tracks, ["id", "artists_id", DAY])
    per_artist = group_count(pairs, ["artists_id", DAY], "pairs")
    genres = distinct_projection(
        artists, [F.col("id").alias("id_artist_unique"), F.col("genres").alias("genre")]
    )
    return (
        inner_renamed(per_artist, genres, "artists_id", "id_artist_unique")
        .groupBy("genre", DAY)
        .agg(F.sum("pairs").alias("count"))
    )


def f_ranking(tracks: DataFrame) -> DataFrame:
    """The artists, as one text, of every track at every chart place."""
    return group_concat(tracks, ["id", DAY, "position"], "artists_name", "artist")


def f_track_statistics(tracks: DataFrame, features: DataFrame) -> DataFrame:
    """Audio features of the track at every chart place, without duplicates.

    Each side is made distinct before the join, which gives the same rows as making
    the join distinct, because every column of both sides stays. The copies of an
    entry are then not multiplied by the join first.
    """
    places = distinct_projection(tracks, [DAY, F.col("id").alias("track_id"), "position"])
    records = distinct_projection(features, TRACK_STATISTICS)
    return inner_renamed(records, places, "id", "track_id")


def load_f_artist(
    artists: DataFrame, tracks: DataFrame, path: str, null_safe: bool = False, written: Days | None = None
) -> None:
    places = tracks.withColumn("id", F.col("artists_id"))
    _load(lambda new: f_artist(artists, new), places, path, "exp/f_artist", null_safe, written)


def load_f_ranking(
    tracks: DataFrame, path: str, null_safe: bool = False, written: Days | None = None
) -> None:
    _load(f_ranking, tracks, path, "exp/f_ranking", null_safe, written)


def load_f_track_statistics(
    tracks: DataFrame, features: DataFrame, path: str, null_safe: bool = False, written: Days | None = None
) -> None:
    _load(
        lambda new: f_track_statistics(new, features), tracks, path, "exp/f_track_statistics",
        null_safe, written,
    )


def _load(
    fact: Callable[[DataFrame], DataFrame], tracks: DataFrame, path: str, table: str, null_safe: bool,
    written: Days | None,
) -> None:
    """Append the fact of the tracks at places that ``path`` does not hold yet.

    The key of a fact stands in the tracks, and no fact row draws on rows of other keys, so
    known places are dropped before the fact is made of the others.
    """
    # The folders of the tracks give the days.
    incremental_append(
        tracks, path, KEYS[table], partition_by=DAY, days=tracks.select(DAY), null_safe=null_safe,
        finish=fact, written=written,
    )
