"""Compressed landings, known places before facts, bounded tasks, many documents to a file."""

from __future__ import annotations

import glob

from conftest import SF_DIR, rows

from chartlake.plans import marts
from chartlake.registry import storage_queries as queries
from chartlake.registry import views
from chartlake.sinks import staging, writers
from chartlake.sources import readers


def test_landed_json_is_compressed_and_its_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "JSON_ROWS", 10)
    path = str(tmp_path / "json")
    writers.write_json(spark.range(35).coalesce(1), path)
    assert len(glob.glob(f"{path}/*.json.gz")) == 4
    assert rows(readers.read_json(spark, path, "id LONG")) == [(i,) for i in range(35)]


def test_entry_documents_are_narrow_when_days_are_brought_together(spark):
    plain, by_day = (views.track_docs(spark, SF_DIR, by_day=b) for b in (False, True))
    columns = [c for c in plain.columns if c not in ("artists", "available_markets")]
    assert rows(plain, "album.name", *columns[1:]) == rows(by_day, "album.name", *columns[1:])
    plan = by_day._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS external_ids") < plan.index("RebalancePartitions")


def test_known_places_go_before_the_fact_is_made(spark, tmp_path, monkeypatch):
    path, given, f_ranking = str(tmp_path / "fact"), [], marts.f_ranking

    def counted(tracks):
        given.append(tracks.count())
        return f_ranking(tracks)

    monkeypatch.setattr(marts, "f_ranking", counted)
    tracks = staging.staged(views.flat_tracks(spark, SF_DIR), "tracks")
    for _ in range(2):
        marts.load_f_ranking(tracks, path)
    assert given == [tracks.count(), 0]


def test_shuffles_get_more_partitions_with_the_input(spark, setting, monkeypatch):
    setting(readers.SPLIT, "64MB")
    setting(readers.SCAN_SPLIT, "134217728b")
    setting(readers.FIRST_PARTITIONS, "2")
    monkeypatch.setattr(readers, "INPUT_A_PARTITION", 1000)
    marts.dim_track(views.flat_tracks(spark, SF_DIR))
    assert int(spark.conf.get(readers.FIRST_PARTITIONS)) > 100
    assert int(spark.conf.get(readers.SPLIT)) == readers.MOST_SHUFFLED
    assert int(spark.conf.get(readers.SCAN_SPLIT)) == readers.MOST_SCANNED


def test_the_inferred_scan_reads_many_documents_a_file(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "artists")
    monkeypatch.setattr(queries, "new_path", lambda *_: path)
    found = queries.scan_json_inferred(spark, SF_DIR).select("id").distinct().count()
    assert found > 1 and len(glob.glob(f"{path}/part-*")) == 1


def test_a_staged_table_can_be_split_in_later_reads(spark, monkeypatch):
    monkeypatch.setattr(staging, "ROW_GROUP", 1 << 16)
    numbers = spark.range(400_000, numPartitions=1).selectExpr("id", "uuid() AS text")
    staged = staging.staged(numbers, "one-file")
    assert staged.count() == 400_000
    path = readers.root_paths(staged)[0].removeprefix("file:")
    import pyarrow.parquet as pq

    (file,) = glob.glob(f"{path}/part-*")
    assert pq.ParquetFile(file).num_row_groups > 4
