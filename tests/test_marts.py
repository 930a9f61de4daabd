from __future__ import annotations

from datetime import date

import pytest
from conftest import final_plan, rows
from documents import ARTISTS, TRACKS, track, write_lines
from pyspark.sql import functions as F

from chartlake.plans import marts, refine
from chartlake.schemas import RAW_ARTISTS, RAW_TRACKS, TRACK_FEATURES
from chartlake.sinks.writers import append_parquet
from chartlake.sources.readers import read_json, read_parquet

D1, D2 = date(2022, 4, 1), date(2022, 4, 2)


@pytest.fixture
def tracks(spark, tmp_path):
    path = str(tmp_path / "ref" / "tracks")
    refine.load_tracks(read_json(spark, write_lines(tmp_path / "t", TRACKS), RAW_TRACKS), path)
    return read_parquet(spark, path)


@pytest.fixture
def artists(spark, tmp_path):
    path = str(tmp_path / "ref" / "artists")
    refine.load_artists(read_json(spark, write_lines(tmp_path / "a", ARTISTS), RAW_ARTISTS), path)
    return read_parquet(spark, path)


@pytest.fixture
def features(spark):
    return spark.createDataFrame(
        [("t1", 0.5, "u"), ("t1", 0.5, "v"), ("t7", 0.25, "w"), (None, 1.0, "x")],
        "id STRING, tempo FLOAT, uri STRING",
    ).select(
        *[
            F.col(f.name) if f.name in ("id", "tempo", "uri")
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.createDataFrame([], TRACK_FEATURES).schema
        ]
    )


def test_f_ranking(tracks):
    assert rows(marts.f_ranking(tracks), "id", "ranking_date", "position", "artist") == [
        ("t1", D1, 1, "A1"),
        ("t1", D2, 1, "A1"),
        ("t2", D1, 2, "A1, A2"),
        ("t5", None, 2, "A1"),
        ("t6", D2, None, "A1"),
        ("t7", D2, 3, "A1"),
    ]


def test_f_artist_keeps_copies_and_both_totals(artists, tracks):
    fact = marts.f_artist(artists, tracks)
    assert set(fact.columns) == {
        "id", "total", "genres", "artists_id", "position", "ranking_date",
    }
    copies = rows(
        fact.groupBy("id", "total", "genres", "ranking_date", "position").count()
    )
    assert ("a1", 100, "pop, rock", D1, 1, 2) in copies
    assert ("a1", 120, "pop", D1, 1, 2) in copies
    assert ("a1", 120, "pop", D2, 3, 4) in copies
    assert ("a2", 7, "samba", D1, 2, 2) in copies
    assert sum(r[-1] for r in copies) == 2 * 14 + 2  # every row of a1 twice, those of a2 once


def test_f_genre_counts_track_and_artist_pairs(artists, tracks):
    fact = marts.f_genre(artists, tracks)
    assert dict(fact.dtypes)["count"] == "bigint"
    assert rows(fact, "genre", "ranking_date", "count") == [
        ("pop", None, 1),
        ("pop", D1, 2),
        ("pop", D2, 3),
        ("rock", None, 1),
        ("rock", D1, 2),
        ("rock", D2, 3),
        ("samba", D1, 1),
    ]


def test_f_genre_equals_the_count_of_the_join(artists, tracks):
    pairs = tracks.select("id", "artists_id", "ranking_date").distinct()
    genres = artists.select(F.col("id").alias("a"), F.col("genres").alias("genre")).distinct()
    plain = pairs.join(genres, F.col("a") == F.col("artists_id")).groupBy("genre", "ranking_date")
    assert rows(plain.count()) == rows(marts.f_genre(artists, tracks))


def test_f_track_statistics(features, tracks):
    fact = marts.f_track_statistics(tracks, features)
    assert "key" not in fact.columns and len(fact.columns) == 16
    assert rows(fact, "id", "track_id", "ranking_date", "position", "tempo") == [
        ("t1", "t1", D1, 1, 0.5), ("t1", "t1", D2, 1, 0.5), ("t7", "t7", D2, 3, 0.25),
    ]
    places = tracks.select("ranking_date", F.col("id").alias("track_id"), "position")
    plain = features.select(*fact.columns[:13]).join(places, F.col("track_id") == F.col("id"))
    assert rows(plain.distinct()) == rows(fact)


def test_dims(artists, tracks):
    assert rows(marts.dim_artist(artists), "id") == [("a1",), ("a2",)]
    assert rows(marts.dim_track(tracks), "id") == [("t1",), ("t2",), ("t5",), ("t6",), ("t7",)]


def test_facts_are_appended_once(spark, tracks, artists, features, tmp_path):
    loads = {
        "f_ranking": lambda p: marts.load_f_ranking(tracks, p),
        "f_artist": lambda p: marts.load_f_artist(artists, tracks, p),
        "f_track_statistics": lambda p: marts.load_f_track_statistics(tracks, features, p),
    }
    for name, load in loads.items():
        path = str(tmp_path / name)
        load(path)
        first = rows(read_parquet(spark, path).dropna(subset=["position", "ranking_date"]))
        load(path)
        again = rows(read_parquet(spark, path).dropna(subset=["position", "ranking_date"]))
        assert first == again and first, name


def test_scans_read_only_what_a_fact_needs(tracks):
    plan = final_plan(marts.f_ranking(tracks))
    assert "ReadSchema: struct<artists_name:string,id:string,position:bigint>" in plan
    assert "Python" not in plan and "Window" not in plan


def test_many_copies_of_one_entry_shrink_before_the_shuffle(spark, tmp_path):
    """A third of all rows are one entry; each map task may send it once."""
    hot = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("A").alias("artists_name"),
        F.lit(1).cast("bigint").alias("position"),
        F.lit("2022-04-01").cast("date").alias("ranking_date"),
    )
    path = str(tmp_path / "hot")
    append_parquet(hot, path)
    fact = marts.f_ranking(read_parquet(spark, path))
    assert fact.filter("id = 'hot'").count() == 1
    assert fact.count() == 20_001
    plan = final_plan(fact)
    assert "HashAggregate" in plan[plan.index("Exchange hashpartitioning(id"):]


def test_only_the_days_of_a_batch_are_read(spark, tracks, tmp_path):
    from chartlake.sinks import incremental

    path = str(tmp_path / "fact")
    marts.load_f_ranking(tracks, path)
    target = read_parquet(spark, path)
    days = spark.createDataFrame([(D1,), (None,)], "ranking_date DATE")
    known = incremental.within_days(target, days, "ranking_date")
    plan = known.select("position")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert ">= 2022-04-01" in scan and "<= 2022-04-0" in scan
    assert {r[0] for r in known.select("ranking_date").collect()} == {D1}
    with_null = incremental.within_days(target, days, "ranking_date", null_safe=True)
    assert {r[0] for r in with_null.select("ranking_date").collect()} == {D1, None}
    nothing = incremental.within_days(target, days.filter("ranking_date is null"), "ranking_date")
    assert nothing.count() == 0


def test_any_number_of_days_prunes(spark, tmp_path):
    """One row with two bounds reaches the driver, however many days the batch has."""
    from chartlake.sinks import incremental

    path = str(tmp_path / "target")
    spark.range(3).select(
        "id", F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") * 9000).cast("int")).alias("d")
    ).write.partitionBy("d").parquet(path)
    days = spark.range(5000).select(
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    known = incremental.within_days(read_parquet(spark, path), days, "d")
    assert rows(known, "id") == []
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert ">= 2000-01-01" in plan and "<= 2013" in plan


def test_batches_in_any_split_give_the_same_table(spark, tmp_path):
    """Keys do not repeat over the batches, so the split does not matter."""
    documents = [track(f"t{i}", f"2022-04-0{1 + i % 3}", i) for i in range(9)]
    results = []
    for name, cuts in (("one", [9]), ("three", [2, 5, 9])):
        path, start = str(tmp_path / name), 0
        for cut in cuts:
            source = write_lines(tmp_path / f"{name}{cut}", documents[start:cut])
            refine.load_tracks(read_json(spark, source, RAW_TRACKS), path)
            start = cut
        results.append(rows(read_parquet(spark, path)))
    assert results[0] == results[1] and len(results[0]) == 18
