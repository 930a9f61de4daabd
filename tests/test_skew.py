"""A third of all rows share one key and nothing may be broadcast.

The joins of the marts must then be split at run time, and give the same rows as
without any of the settings.
"""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from chartlake.plans import landing, marts
from chartlake.schemas import TRACK_STATISTICS

ROWS = 120_000


@pytest.fixture
def no_broadcast(setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "32KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    # Keep as many shuffle files as a cluster would have; a split takes whole files.
    setting("spark.sql.shuffle.partitions", 16)
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")


def hot(column):
    return F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id") % 5000)


@pytest.fixture
def tracks(spark):
    return spark.range(0, ROWS, 1, 16).select(
        hot("id").alias("id"),
        hot("id").alias("artists_id"),
        F.col("id").alias("position"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias(
            "ranking_date"
        ),
    )


@pytest.fixture
def artists(spark):
    return spark.range(-10, 5000, 1, 16).select(
        "id", F.lit(1.0).alias("total"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("genres")
    )


@pytest.fixture
def features(spark):
    return spark.range(-10, 5000, 1, 16).select(
        *[F.col("id") if c == "id" else F.xxhash64("id").alias(c) for c in TRACK_STATISTICS]
    )


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


def test_f_artist(tracks, artists, no_broadcast):
    fact = marts.f_artist(artists, tracks)
    assert "SortMergeJoin(skew=true)" in final_plan(fact)
    got = multiset(fact.select("artists_id", "genres", "position"))
    assert got == multiset(
        tracks.select("artists_id", F.lit("a, b").alias("genres"), "position")
    )


def test_f_track_statistics(tracks, features, no_broadcast):
    doubled = tracks.union(tracks)
    fact = marts.f_track_statistics(doubled, features)
    assert "SortMergeJoin(skew=true)" in final_plan(fact)
    got = multiset(fact.select("track_id", "position", "tempo"))
    assert got == multiset(tracks.select("id", "position", F.xxhash64("id").alias("tempo")))


def test_f_genre_has_no_hot_key_left(tracks, artists, no_broadcast):
    """A day's pairs of one artist are one row by the time of the join."""
    pairs = Counter(
        (r[0], r[1]) for r in tracks.select("id", "artists_id", "ranking_date").distinct()
        .select("ranking_date", "id").collect()
    )
    per_day = Counter()
    for (day, _), n in pairs.items():
        per_day[day] += n
    fact = marts.f_genre(artists, tracks)
    assert {(r.genre, r.ranking_date): r["count"] for r in fact.collect()} == {
        (genre, day): n for day, n in per_day.items() for genre in ("a", "b")
    }


def test_landing(spark, no_broadcast):
    """A third of the entries name one track, and a third of them take one place."""
    entries = spark.range(0, ROWS, 1, 16).select(
        hot("id").cast("string").alias("track_id"),
        F.when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 400 + 2).alias("position"),
        F.lit("2022-04-01").alias("date_ranking"),
        F.col("id").alias("seq"),
        F.xxhash64("id").alias("payload"),
    )
    lookup = spark.range(-10, 4000, 1, 16).select(
        F.col("id").cast("string").alias("id"),
        F.array(F.struct(F.col("id").cast("string").alias("id"))).alias("artists"),
    )
    landed = landing.land_entries(entries, lookup, lookup, lookup, ["seq"])
    expected = {}
    for i in range(ROWS):
        track = -7 if i % 3 == 0 else i % 5000
        if track < 4000:
            expected[1 if i % 3 == 1 else i % 400 + 2] = str(track)
    assert {r.position: r.id for r in landed.tracks.collect()} == expected
    ids = {str(-7 if i % 3 == 0 else i % 5000) for i in range(ROWS)}
    known = {i for i in ids if int(i) < 4000}
    assert {r.id for r in landed.tracks_features.collect()} == known
    assert {r.id for r in landed.artists.collect()} == known
