"""Landed documents to flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.functions.columns import parse_day
from chartlake.operators.aggregates import latest_by_key
from chartlake.operators.generators import explode_columns
from chartlake.operators.projections import leaves, prefixed
from chartlake.schemas import (
    ALBUM_FIELDS,
    ARTIST_FIELDS,
    DAY,
    KEYS,
    LANDED_KEYS,
    REF_ARTISTS,
    REF_TRACKS_OWN,
    TRACK_FEATURES,
)
from chartlake.sinks.incremental import incremental_append
from chartlake.sinks.writers import rebalanced
from chartlake.sources.readers import folder_values, partition_columns


def flat_artists(docs: DataFrame, outer: bool = False, dedupe: bool = False) -> DataFrame:
    """Artist documents to one row per artist, genre and image.

    Artists without a genre or without an image vanish unless ``outer``.
    """
    rows = explode_columns(docs, ["genres", "images"], outer).select(
        *leaves(*REF_ARTISTS)
    )
    return rows.distinct() if dedupe else rows


def flat_tracks(docs: DataFrame, outer: bool = False, dedupe: bool = False) -> DataFrame:
    """Chart entry documents to one row per entry, artist and market.

    The market itself is not kept, so each entry appears once per market. ``dedupe``
    drops these copies; ``outer`` keeps entries without artists or markets.
    """
    return _flat_tracks(with_day(docs), outer, dedupe)


def with_day(docs: DataFrame) -> DataFrame:
    return docs.withColumn(DAY, parse_day(F.col("date_ranking")))


def _flat_tracks(docs: DataFrame, outer: bool, dedupe: bool) -> DataFrame:
    rows = explode_columns(docs, ["artists", "available_markets"], outer).select(
        *leaves("album.album_type"),
        *prefixed("album", ALBUM_FIELDS),
        *prefixed("artists", ARTIST_FIELDS),
        *leaves(*REF_TRACKS_OWN),
        DAY,
    )
    return rows.distinct() if dedupe else rows


def load_artists(
    docs: DataFrame,
    path: str,
    outer: bool = False,
    dedupe: bool = False,
    run: str | None = None,
    null_safe: bool = False,
) -> None:
    """Append the artists that ``path`` does not hold yet.

    ``run`` names a column that orders the documents of one key; only the last of them
    is then used. That choice is made among the unseen documents alone.
    """
    incremental_append(
        docs,
        path,
        KEYS["ref/artists"],
        null_safe=null_safe,
        finish=lambda new: flat_artists(_latest(new, "artists", run), outer, dedupe),
        wide=True,
    )


def load_tracks(
    docs: DataFrame,
    path: str,
    outer: bool = False,
    dedupe: bool = False,
    run: str | None = None,
    null_safe: bool = False,
) -> None:
    """Append the chart entries whose position and day ``path`` does not hold yet.

    Seen entries are dropped and the days brought together while an entry is still
    one document; artists and markets multiply it only in the writing tasks. Documents whose
    files lie in folders by day are together as they are, and their days are known from the
    listing of the folders, without reading a document. ``run`` is as in ``load_artists``.
    """
    listed = folder_values(docs, "date_ranking")
    together = run is None and "date_ranking" in partition_columns(docs)

    def finish(new: DataFrame) -> DataFrame:
        latest = _latest(new, "tracks", run)
        return _flat_tracks(latest if together else rebalanced(latest, DAY), outer, dedupe)

    incremental_append(
        with_day(docs),
        path,
        KEYS["ref/tracks"],
        partition_by=DAY,
        days=with_day(docs if listed is None else listed).select(DAY),
        null_safe=null_safe,
        finish=finish,
        rebalance=dedupe,
        wide=True,
    )


def load_track_features(docs: DataFrame, path: str, run: str | None = None) -> None:
    """Append the feature records of tracks that ``path`` does not hold yet.

    Records without an id, such as lines that are not JSON, belong to no track and go.
    """
    incremental_append(
        docs.filter(F.col("id").isNotNull()),
        path,
        KEYS["ref/tracks_features"],
        schema=TRACK_FEATURES,
        finish=lambda new: _latest(new, "tracks_features", run),
        wide=True,
    )


def _latest(docs: DataFrame, kind: str, run: str | None) -> DataFrame:
    return docs if run is None else latest_by_key(docs, LANDED_KEYS[kind], [run]).drop(run)
