"""The jobs end to end over one small lake, and the file stream."""

from __future__ import annotations

import json
from datetime import date

import pytest
from conftest import rows
from documents import FEATURES, TRACKS, artist, track, write_lines, write_one_per_file

from chartlake.plans import jobs, landing, refine
from chartlake.schemas import RAW_ARTISTS, RAW_TRACKS, TRACK_FEATURES
from chartlake.sources.readers import read_json, read_parquet
from chartlake.streaming.ingest import load_new_files

LOOKUP_TRACKS = [
    track("t1", None, None, artists=("a1",)),
    track("t2", None, None, artists=("a1", "a2")),
    track("t3", None, None, artists=("a3",)),
]
OTHER_INPUT = ("csv_to_parquet", "order_total", "landed_rejects", "landed_drift")
LOOKUP_ARTISTS = [artist(a, 5, ["pop"]) for a in ("a1", "a2", "a3", "a4")]


def daily(*ids):
    return {"items": [{"track": {"id": i}} for i in ids]}


def archived(*pairs):
    return {"tracks": [{"url": f"https://x/track/{i}?si=1", "added_at": at} for i, at in pairs]}


def take(tmp_path, run, *ids):
    """The snapshot that the daily run of this name takes; earlier ones stay."""
    write_one_per_file(tmp_path / "snapshots" / "daily" / f"taken={run}", [daily(*ids)])


@pytest.fixture
def root(spark, tmp_path):
    for kind, documents, schema in (
        ("tracks", LOOKUP_TRACKS, RAW_TRACKS),
        ("tracks_features", FEATURES, TRACK_FEATURES),
        ("artists", LOOKUP_ARTISTS, RAW_ARTISTS),
    ):
        docs = read_json(spark, write_lines(tmp_path / "docs" / kind, documents), schema)
        docs.drop("position", "date_ranking").write.parquet(str(tmp_path / "lookup" / kind))
    take(tmp_path, "2022-04-01T235959", "t2", "t1", "gone", "t1")
    return str(tmp_path)


def test_daily_lake(spark, root, tmp_path):
    jobs.land_daily(spark, root, "2022-04-01 23:59:59")
    landed = read_json(spark, f"{root}/raw/tracks", RAW_TRACKS)
    assert rows(landed, "date_ranking", "position", "id") == [
        ("2022-04-01", 1, "t2"), ("2022-04-01", 2, "t1"), ("2022-04-01", 4, "t1"),
    ]
    features = read_json(spark, f"{root}/raw/tracks_features", TRACK_FEATURES)
    assert rows(features, "id") == [("t1",), ("t2",)]
    assert rows(read_json(spark, f"{root}/raw/artists", RAW_ARTISTS), "id") == [("a1",), ("a2",)]

    for name in list(jobs.JOBS)[2:]:
        if name not in OTHER_INPUT:
            jobs.JOBS[name](spark, root)
    day = date(2022, 4, 1)
    assert rows(spark.table("tracks.f_ranking"), "ranking_date", "position", "id", "artist") == [
        (day, 1, "t2", "A1, A2"), (day, 2, "t1", "A1"), (day, 4, "t1", "A1"),
    ]
    assert rows(spark.table("tracks.f_genre"), "genre", "ranking_date", "count") == [("pop", day, 3)]
    assert rows(spark.table("tracks.f_track_statistics"), "track_id", "position", "tempo") == [
        ("t1", 2, 120.5), ("t1", 4, 120.5), ("t2", 1, None),
    ]
    assert spark.table("tracks.f_artist").count() == 8  # two markets
    assert spark.table("tracks.dim_artist").count() == 2
    assert spark.table("tracks.dim_track").count() == 2

    before = {n: spark.table(f"tracks.{n}").count() for n in ("f_ranking", "f_artist")}
    take(tmp_path, "2022-04-02T000001", "t3")
    jobs.land_daily(spark, root, "2022-04-02 00:00:01")
    second = landing.landed_documents(spark, f"{root}/raw", "tracks", RAW_TRACKS, ["2022-04-02T000001"])
    assert rows(second, "date_ranking", "position", "id") == [("2022-04-02", 1, "t3")]
    later = {
        "ref_artists": {"runs": ["2022-04-02T000001"]},
        "ref_tracks": {"runs": ["2022-04-02T000001"]},
        "ref_tracks_features": {"runs": ["2022-04-02T000001"]},
        "f_artist": {"since": "2022-04-02"},
        "f_ranking": {"since": "2022-04-02"},
        "f_track_statistics": {"since": "2022-04-02"},
    }
    for name in list(jobs.JOBS)[2:]:
        if name not in OTHER_INPUT:
            jobs.JOBS[name](spark, root, **later.get(name, {}))
    assert spark.table("tracks.f_ranking").count() == before["f_ranking"] + 1
    assert spark.table("tracks.f_artist").count() == before["f_artist"] + 2


def test_a_later_run_replaces_the_document_of_a_key(spark, root, tmp_path):
    take(tmp_path, "2022-04-01T100000", "t2", "t1", "gone", "t1")
    jobs.land_daily(spark, root, "2022-04-01 10:00:00")
    take(tmp_path, "2022-04-01T110000", "t3")
    jobs.land_daily(spark, root, "2022-04-01 11:00:00")
    landed = landing.read_landed(spark, f"{root}/raw", "tracks", RAW_TRACKS)
    assert rows(landed, "position", "id") == [(1, "t3"), (2, "t1"), (4, "t1")]
    first = landing.read_landed(
        spark, f"{root}/raw", "tracks", RAW_TRACKS, runs=["2022-04-01T100000"]
    )
    assert rows(first, "position", "id") == [(1, "t2"), (2, "t1"), (4, "t1")]


def test_refine_uses_the_latest_document_of_a_key(spark, root, tmp_path):
    take(tmp_path, "2022-04-01T100000", "t2", "t1", "gone", "t1")
    jobs.land_daily(spark, root, "2022-04-01 10:00:00")
    take(tmp_path, "2022-04-01T110000", "t3")
    jobs.land_daily(spark, root, "2022-04-01 11:00:00")
    jobs.ref_tracks(spark, root)
    table = read_parquet(spark, f"{root}/ref/tracks")
    assert rows(table.distinct(), "position", "id") == [(1, "t3"), (2, "t1"), (4, "t1")]
    assert "run" not in table.columns


def test_history(spark, root, tmp_path):
    folder = tmp_path / "snapshots" / "history"
    for day, snapshot in {
        "2022-03-31": archived(("t3", "2022-03-31T00:00:00Z")),
        "2022-04-01": archived(("t1", "2022-04-01T01:00:00Z"), ("t2", "2022-03-30T00:00:00Z")),
        "2022-04-30": archived(("t2", "2022-04-01T02:00:00Z")),
        "2022-10-01": archived(("t3", "2022-04-01T03:00:00Z")),
    }.items():
        write_one_per_file(folder / f"snapshot_day={day}", [snapshot])
    april = [("2022-04-01", "2022-04-30")]
    jobs.land_history(spark, root, "2022-10-02 00:00:00", april)
    landed = landing.read_landed(spark, f"{root}/raw", "tracks", RAW_TRACKS)
    # The later snapshot takes the place of the earlier one at (2022-04-01, 1).
    assert rows(landed, "date_ranking", "position", "id") == [
        ("2022-03-30", 2, "t2"), ("2022-04-01", 1, "t2"),
    ]
    jobs.land_history(spark, root, "2022-10-03 00:00:00", [("2022-03-31", "2022-03-31")])
    landed = landing.read_landed(spark, f"{root}/raw", "tracks", RAW_TRACKS)
    assert ("2022-03-31", 1, "t3") in rows(landed, "date_ranking", "position", "id")
    # Without ranges every snapshot counts, and the one of October is the latest.
    jobs.land_history(spark, root, "2022-10-04 00:00:00")
    landed = landing.read_landed(spark, f"{root}/raw", "tracks", RAW_TRACKS)
    assert rows(landed, "date_ranking", "position", "id") == [
        ("2022-03-30", 2, "t2"), ("2022-03-31", 1, "t3"), ("2022-04-01", 1, "t3"),
    ]


def test_the_later_snapshot_of_a_day_wins(spark, root, tmp_path):
    folder = tmp_path / "snapshots" / "history" / "snapshot_day=2022-05-01"
    at = "2022-05-01T00:00:00Z"
    write_one_per_file(folder, [archived(("t3", at)), archived(("t1", at))])
    jobs.land_history(spark, root, "2022-05-02 00:00:00")
    landed = landing.read_landed(spark, f"{root}/raw", "tracks", RAW_TRACKS)
    assert rows(landed, "position", "id") == [(1, "t1")]


def test_null_keys_and_bad_records(spark, root, tmp_path):
    raw = tmp_path / "raw"
    nulls = [track("t1", "2022-04-01", None), track("t2", "2022-04-01", None)]
    write_lines(raw / "tracks" / "run=1", nulls)
    jobs.ref_tracks(spark, root)
    table = read_parquet(spark, f"{root}/ref/tracks")
    assert rows(table.select("id").distinct()) == [("t1",), ("t2",)]
    (raw / "tracks_features" / "run=1").mkdir(parents=True)
    (raw / "tracks_features" / "run=1" / "part.json").write_text('{"id": "t1"}\nnot json\n{"mode": 1.0}\n')
    for _ in range(2):
        jobs.ref_tracks_features(spark, root)
    assert rows(read_parquet(spark, f"{root}/ref/tracks_features", TRACK_FEATURES), "id") == [("t1",)]


def test_history_prunes_snapshot_folders(spark, root, tmp_path):
    folder = tmp_path / "snapshots" / "history"
    for day in ("2022-04-01", "2022-12-01"):
        write_one_per_file(folder / f"snapshot_day={day}", [archived(("t1", day))])
    snapshots = spark.read.schema(
        "tracks ARRAY<STRUCT<url: STRING, added_at: STRING>>, snapshot_day DATE"
    ).json(str(folder))
    wanted = landing.in_ranges(snapshots, "snapshot_day", [("2022-04-01", "2022-05-31")])
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "< 2022-06-01)], PushedFilters" in plan and "PartitionFilters: [isnotnull(snapshot_day" in plan


def test_command_line(monkeypatch, spark, root, tmp_path):
    import chartlake.__main__ as cli

    class Kept:
        def __getattr__(self, name):
            return getattr(spark, name)

        def stop(self):
            pass

    monkeypatch.setattr(cli, "build_session", lambda *_: Kept())
    (tmp_path / "landing-zone").mkdir()
    (tmp_path / "landing-zone" / "in.csv").write_text("a,b\n1,x\n")
    cli.main(["csv_to_parquet", "--root", root + "/"])
    assert rows(read_parquet(spark, f"{root}/processing/csv")) == [(1, "x")]
    (tmp_path / "orders").mkdir()
    (tmp_path / "orders" / "day.json").write_text(
        '{"7": 12.5, "8": 30.25, "9": 1.1}\n'
    )
    cli.main(["order_total", "--root", root])
    totals = read_parquet(spark, f"{root}/processing/order_totals")
    assert totals.first()["total_text"] == "43.85"
    take(tmp_path, "2022-04-01T000000", "t2", "t1", "gone", "t1")
    cli.main(["land_daily", "--root", root, "--run", "2022-04-01 00:00:00"])
    cli.main(["ref_tracks", "--root", root, "--runs", "2022-04-01T000000", "--dedupe", "--null-safe"])
    cli.main(["f_ranking", "--root", root, "--since", "2022-04-01"])
    assert read_parquet(spark, f"{root}/exp/f_ranking").count() == 3
    cli.main(["csv_to_parquet", "--root", root, "--schema", "a STRING, b STRING"])
    assert rows(read_parquet(spark, f"{root}/processing/csv")) == [("1", "x")]
    write_one_per_file(
        tmp_path / "snapshots" / "history" / "snapshot_day=2022-06-01", [archived(("t1", "2022-06-01"))]
    )
    cli.main(["land_history", "--root", root, "--run", "2022-07-01 00:00:00", "--ranges", "2022-06-01:2022-06-30"])
    landed = landing.read_landed(spark, f"{root}/raw", "tracks", RAW_TRACKS)
    assert ("2022-06-01", 1, "t1") in rows(landed, "date_ranking", "position", "id")
    for wrong in (["dim_track", "--outer"], ["land_history", "--run", "x", "--ranges", "May"], ["land_daily"], ["f_ranking", "--runs", "x"], ["dim_track", "--since", "x"]):
        with pytest.raises(SystemExit):
            cli.main([*wrong, "--root", root])


def test_stream_of_new_files(spark, tmp_path):
    source, path = tmp_path / "raw", str(tmp_path / "ref")
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        query = load_new_files(
            spark, str(source), RAW_TRACKS, lambda b: refine.load_tracks(b, path), checkpoint
        )
        query.awaitTermination()
        return rows(read_parquet(spark, path), "id", "ranking_date", "position")

    write_lines(source, TRACKS)
    first = run()
    assert run() == first  # no new files: not even the rows with a null key are repeated
    (source / "more.json").write_text(json.dumps(track("t9", "2022-04-03", 1)) + "\n")
    assert len(run()) == len(first) + 2
    batch = refine.flat_tracks(read_json(spark, str(source), RAW_TRACKS))
    assert rows(batch, "id", "ranking_date", "position") == rows(
        read_parquet(spark, path), "id", "ranking_date", "position"
    )
