"""Chart snapshots to landed documents.

A snapshot is one document with the ordered list of the tracks of a chart. Landing
ranks the list, looks every track, its features and its artists up, and keeps the
last document of each key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import takewhile
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, NumericType

from chartlake.functions.columns import day_text, natural_key, timestamp_text, url_last_segment
from chartlake.operators.aggregates import last_by_key, latest_by_key
from chartlake.operators.generators import rank_entries
from chartlake.operators.joins import anti_join, enrich
from chartlake.schemas import LANDED_KEYS
from chartlake.sinks.narrowing import passing_by, semi_join, too_many_to_broadcast
from chartlake.sinks.staging import staged
from chartlake.sinks.writers import write_json
from chartlake.sources.readers import read_json

# Fixed value: the folder and name that start the key of a landed chart entry.
TRACKS_PREFIX = "tracks/musica"
# Entries of one place that are joined to the known tracks, where not all entries are.
CANDIDATES = 4


class Landed(NamedTuple):
    tracks: DataFrame
    tracks_features: DataFrame
    artists: DataFrame


def tracks_key(day: Column, position: Column) -> Column:
    return natural_key(TRACKS_PREFIX, day, position, ".json")


def record_key(kind: str, record_id: Column) -> Column:
    return natural_key(f"{kind}/", record_id, ".json")


def in_ranges(df: DataFrame, day: str, ranges: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows whose day lies in any of the ranges, both ends included.

    ``day`` is a date or a timestamp column. It is compared as it is, not cast, so the
    ranges prune partitions or reach the scan as pushed filters.
    """
    kind = df.schema[day].dataType.typeName()
    wanted = F.lit(False)
    for low, high in ranges:
        after_high = F.date_add(F.lit(high).cast("date"), 1)
        wanted = wanted | (
            (F.col(day) >= F.lit(low).cast("date").cast(kind))
            & (F.col(day) < after_high.cast(kind))
        )
    return df.filter(wanted)


def daily_entries(snapshots: DataFrame, taken_at: str) -> DataFrame:
    """Entries of daily snapshots; all of one snapshot get the day it was taken.

    ``taken_at`` is a timestamp column, so a rerun gives the same days and a run over
    midnight does not split a chart.
    """
    # The day belongs to the snapshot: it is worked out before the list is exploded.
    dated = snapshots.withColumn("date_ranking", day_text(timestamp_text(F.col(taken_at))))
    return rank_entries(dated, "items", "item").select(
        *snapshots.drop("items").columns,
        F.col("item.track.id").alias("track_id"),
        "position",
        "date_ranking",
    )


def history_entries(snapshots: DataFrame) -> DataFrame:
    """Entries of archived snapshots; the day is that on which the track was added."""
    return rank_entries(snapshots, "tracks", "entry").select(
        *snapshots.drop("tracks").columns,
        url_last_segment(F.col("entry.url")).alias("track_id"),
        "position",
        day_text(F.col("entry.added_at")).alias("date_ranking"),
    )


def land_entries(
    entries: DataFrame,
    tracks: DataFrame,
    features: DataFrame,
    artists: DataFrame,
    order: Sequence[str],
) -> Landed:
    """Documents to land for the ranked entries.

    ``tracks``, ``features`` and ``artists`` hold one record per ``id``. ``order``
    names the entry columns that say which entry was seen later; it decides between
    two entries at the same place of the same day, so it must tell snapshots apart. That
    decision needs the entry alone, so it is made before the wide track records are
    joined. A record looked up by its own id is the same whichever entry asked for it, so
    features and artists only need their ids to be distinct.

    Which tracks are known and by whom they are is read from the lookup as ids; its wide records
    are read for the few entries that are left. What follows from the entries is written to the
    shared folder, so that ``entries`` are not needed any more.
    """
    listed = entries.select(F.col("track_id").alias("id")).distinct()
    ids = tracks.select("id", F.col("artists.id").alias("artist_ids"))
    found = staged(ids.join(listed, "id", "left_semi").select(*ids.columns), "found-tracks")
    found_ids = staged(found.select("id"), "found-ids")
    placed = latest_known(
        entries, found_ids.withColumnRenamed("id", "track_id"), LANDED_KEYS["tracks"], order
    )
    documents = enrich(staged(placed, "placed"), tracks, "track_id").select(
        "record.*", F.col("position").cast("bigint").alias("position"), "date_ranking"
    )
    artist_ids = staged(found.select(F.explode("artist_ids").alias("id")).distinct(), "found-artists")
    return Landed(
        tracks=documents,
        tracks_features=semi_join(features, found_ids, ["id"]),
        artists=semi_join(artists, artist_ids, ["id"]),
    )


def latest_known(
    entries: DataFrame, known: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Track, place and day of the last entry of each key; only entries of known tracks compete.

    ``known`` is a written table of track ids. If they are too many to be broadcast, entries are
    not shuffled to be joined to them: bitmaps of the ids let hardly any unknown entry pass, and
    only the last ``CANDIDATES`` of a key are joined. Few entries are sorted to find these, as
    the greatest of the first order columns are found by hashing. A key none of whose candidates
    is known is looked for once more among all its entries, if it has others.
    """

    def last(rows: DataFrame) -> DataFrame:
        sure = rows.join(known, "track_id", "left_semi")
        return latest_by_key(sure, keys, order).select("track_id", "position", "date_ranking")

    if not too_many_to_broadcast(known):
        return last(entries)
    needed = dict.fromkeys(["track_id", "position", "date_ranking", *keys, *order])
    possible = passing_by(known, ["track_id"])(entries.select(*needed))
    hashable = takewhile(lambda c: isinstance(entries.schema[c].dataType, (NumericType, DatetimeType)), order)
    late, places = possible, None
    for column in list(hashable)[:2] or [None]:
        every = F.count(F.lit(1)).alias("_every")
        greatest = [F.max(column).alias("_greatest")] if column else []
        found = staged(late.groupBy(*keys).agg(every, *greatest), "places")
        places = places or found
        if column and not too_many_to_broadcast(found):
            late = _greatest_of_keys(late, found, keys, column)
    few = staged(last_by_key(late, keys, order, CANDIDATES), "last-entries")
    placed = staged(last(few), "placed-at-once")
    partly = few.groupBy(*keys).count().join(places, list(keys)).filter("count < _every").select(*keys)
    unsure = staged(anti_join(partly, placed, keys), "unsure-places")
    if unsure.isEmpty():
        return placed
    return placed.unionByName(last(possible.join(unsure, list(keys), "left_semi")))


def _greatest_of_keys(rows: DataFrame, found: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows with the greatest ``column`` of their key; those with a null in their key all stay."""
    unnamed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    joined = rows.join(found.select(*keys, "_greatest"), list(keys), "left")
    return joined.filter(unnamed | F.col(column).eqNullSafe(F.col("_greatest"))).select(*rows.columns)


def write_landed(landed: Landed, root: str, run: str) -> None:
    """Write the documents of one run as ``<root>/<kind>/run=<run>/``.

    Writing the same run again replaces it. Runs are compared as text, so their names
    must sort in time order.
    """
    write_json(landed.tracks, f"{root}/tracks/run={run}", partition_by="date_ranking")
    write_json(landed.tracks_features, f"{root}/tracks_features/run={run}")
    write_json(landed.artists, f"{root}/artists/run={run}")


def landed_documents(
    spark: SparkSession, root: str, kind: str, schema: str, runs: Sequence[str] | None = None
) -> DataFrame:
    """All landed documents with the ``run`` they came from.

    With ``runs`` only the folders of these runs are read.
    """
    documents = read_json(spark, f"{root}/{kind}", f"{schema}, run STRING")
    return documents if runs is None else documents.filter(F.col("run").isin(*runs))


def read_landed(
    spark: SparkSession, root: str, kind: str, schema: str, runs: Sequence[str] | None = None
) -> DataFrame:
    """The landed documents; of each key the one of the latest run."""
    documents = landed_documents(spark, root, kind, schema, runs)
    return latest_by_key(documents, LANDED_KEYS[kind], ["run"]).drop("run")
