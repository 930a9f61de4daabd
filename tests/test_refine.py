from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from conftest import rows
from documents import ARTISTS, FEATURES, TRACKS, track, write_lines, write_one_per_file

from chartlake import schemas
from chartlake.plans import refine
from chartlake.schemas import RAW_ARTISTS, RAW_TRACKS, TRACK_FEATURES
from chartlake.sources.readers import read_json, read_parquet

D1, D2 = date(2022, 4, 1), date(2022, 4, 2)


@pytest.fixture
def docs(spark, tmp_path):
    return read_json(spark, write_lines(tmp_path / "raw", TRACKS), RAW_TRACKS)


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_tracks_have_one_row_per_artist_and_market(docs):
    got = counted(refine.flat_tracks(docs), "id", "ranking_date", "position", "artists_id")
    assert got == {
        ("t1", D1, 1, "a1"): 2,
        ("t2", D1, 2, "a1"): 2,
        ("t2", D1, 2, "a2"): 2,
        ("t1", D2, 1, "a1"): 2,
        ("t5", None, 2, "a1"): 2,
        ("t6", D2, None, "a1"): 2,
        ("t7", D2, 3, "a1"): 4,
    }


def test_row_count_is_the_sum_of_the_products(docs):
    sizes = sum(len(t["artists"] or ()) * len(t["available_markets"] or ()) for t in TRACKS)
    assert refine.flat_tracks(docs).count() == sizes


def test_tracks_columns(docs):
    own = [path.rsplit(".", 1)[-1] for path in schemas.REF_TRACKS_OWN]
    assert refine.flat_tracks(docs).columns == [
        "album_type", *[f"album_{f}" for f in schemas.ALBUM_FIELDS],
        *[f"artists_{f}" for f in schemas.ARTIST_FIELDS], *own, "ranking_date",
    ]


def test_outer_keeps_and_dedupe_drops(docs):
    outer = counted(refine.flat_tracks(docs, outer=True), "id", "artists_id")
    assert outer[("t3", "a1")] == 1 and outer[("t4", None)] == 2 and outer[("t8", "a1")] == 1
    deduped = counted(refine.flat_tracks(docs, dedupe=True), "id", "ranking_date", "artists_id")
    assert set(deduped.values()) == {1}


def test_artists(spark, tmp_path):
    docs = read_json(spark, write_one_per_file(tmp_path / "raw", ARTISTS), RAW_ARTISTS, True)
    got = counted(refine.flat_artists(docs), "id", "total", "genres", "height")
    assert got == {
        ("a1", 100, "pop", 64): 1,
        ("a1", 100, "pop", 300): 1,
        ("a1", 100, "rock", 64): 1,
        ("a1", 100, "rock", 300): 1,
        ("a1", 120, "pop", 64): 1,
        ("a1", 120, "pop", 300): 1,
        ("a2", 7, "samba", 64): 1,
    }
    assert refine.flat_artists(docs).columns == [p.rsplit(".", 1)[-1] for p in schemas.REF_ARTISTS]


def test_inferred_and_given_schema_agree(spark, tmp_path):
    path = write_one_per_file(tmp_path / "raw", ARTISTS)
    inferred = refine.flat_artists(read_json(spark, path, multi_line=True))
    given = refine.flat_artists(read_json(spark, path, RAW_ARTISTS, True))
    assert inferred.schema.simpleString() == given.schema.simpleString()
    assert rows(inferred) == rows(given)


def test_load_tracks_twice_adds_only_rows_with_a_null_key(spark, docs, tmp_path):
    path = str(tmp_path / "ref")
    refine.load_tracks(docs, path)
    first = counted(read_parquet(spark, path), "id", "ranking_date", "position")
    refine.load_tracks(docs, path)
    second = counted(read_parquet(spark, path), "id", "ranking_date", "position")
    assert second - first == {("t5", None, 2): 2, ("t6", D2, None): 2}
    assert (tmp_path / "ref" / "ranking_date=__HIVE_DEFAULT_PARTITION__").is_dir()


def test_first_write_wins(spark, tmp_path):
    path = str(tmp_path / "ref")
    for name, batch in (
        ("one", [track("t1", "2022-04-01", 1)]),
        ("two", [track("other", "2022-04-01", 1), track("new", "2022-04-01", 2)]),
    ):
        refine.load_tracks(
            read_json(spark, write_lines(tmp_path / name, batch), RAW_TRACKS), path
        )
    assert counted(read_parquet(spark, path), "id", "position") == {("t1", 1): 2, ("new", 2): 2}


def test_load_artists_and_features(spark, tmp_path):
    docs = read_json(spark, write_lines(tmp_path / "artists", ARTISTS), RAW_ARTISTS)
    path = str(tmp_path / "ref_artists")
    for _ in range(2):
        refine.load_artists(docs, path)
    assert rows(read_parquet(spark, path)) == rows(refine.flat_artists(docs))

    features = read_json(spark, write_lines(tmp_path / "features", FEATURES), TRACK_FEATURES)
    path = str(tmp_path / "ref_features")
    for batch in (features.filter("id = 't1'"), features, features):
        refine.load_track_features(batch, path)
    table = read_parquet(spark, path, TRACK_FEATURES)
    assert len(table.columns) == 18
    assert rows(table, "id", "tempo", "duration_ms", "energy") == [
        ("t1", 120.5, 1000, None), ("t2", None, 2000, None), ("t7", None, None, 0.25),
    ]
