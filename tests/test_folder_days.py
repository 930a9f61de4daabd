"""Days of documents in folders by day, without reading a document."""

from __future__ import annotations

from conftest import rows
from documents import track
from pyspark.sql import functions as F

from chartlake.functions.columns import parse_day
from chartlake.plans import refine
from chartlake.schemas import RAW_TRACKS
from chartlake.sinks import incremental
from chartlake.sources.readers import file_relations, folder_values, read_json, read_parquet

ODD_DAYS = [
    "2022-04-01", "2022-13-40", "2023-02-29", "2024-02-29", "0000-01-01", "9999-12-31",
    "+12022-04-01", "2022-4-1", " 2022-04-01", "2022-04-01\n", "2022-04-01T00", "", None,
]


def by_day(spark, path: str):
    found = [("1", "2022/04 01%, a=b", 1), ("1", None, 2), ("2", "2022-04-02", 3)]
    docs = spark.createDataFrame(found, "run string, date_ranking string, id int")
    docs.write.partitionBy("run", "date_ranking").json(path)
    return read_json(spark, path, "id int, date_ranking string, run string")


def test_values_come_from_the_folders_that_filters_leave(spark, tmp_path):
    docs = by_day(spark, str(tmp_path / "docs"))
    listed = folder_values(docs.filter("id < 9"), "date_ranking")
    assert rows(listed) == [(None,), ("2022-04-02",), ("2022/04 01%, a=b",)]
    assert rows(folder_values(docs.filter("run = '2'"), "date_ranking")) == [("2022-04-02",)]
    assert rows(folder_values(docs.filter("run = '3'"), "date_ranking")) == []
    assert file_relations(listed) == []


def test_no_values_where_the_column_is_not_that_of_the_folders(spark, tmp_path):
    docs = by_day(spark, str(tmp_path / "docs"))
    assert folder_values(docs, "id") is None
    assert folder_values(docs.withColumn("date_ranking", F.upper("date_ranking")), "date_ranking") is None
    assert folder_values(docs.union(docs), "date_ranking") is None
    assert folder_values(spark.range(3), "id") is None


def test_a_load_reads_no_document_for_its_days(spark, tmp_path, monkeypatch):
    given, within = [], incremental.within_days

    def watched(target, days, *more):
        given.append(days)
        return within(target, days, *more)

    monkeypatch.setattr(incremental, "within_days", watched)
    raw, path = str(tmp_path / "raw"), str(tmp_path / "ref")
    lines = [track("t1", "2022-04-01", 1), track("t2", "2022-04-02", 1), track("t3", "2022-13-40", 2)]
    spark.createDataFrame(lines, RAW_TRACKS).write.partitionBy("date_ranking").json(raw)
    docs = read_json(spark, raw, RAW_TRACKS)
    refine.load_tracks(docs.filter("date_ranking < '2022-04-02'"), path)
    refine.load_tracks(docs, path)
    assert [file_relations(days) for days in given] == [[]]
    held = rows(read_parquet(spark, path).distinct(), "id", "position")
    assert held == [("t1", 1), ("t2", 1), ("t3", 2)]


def test_days_are_those_of_the_pattern(spark):
    texts = spark.createDataFrame([(t,) for t in ODD_DAYS], "text string")
    days = texts.select(parse_day(F.col("text")), F.try_to_date("text", "yyyy-MM-dd"))
    assert all(day == by_pattern for day, by_pattern in rows(days.select(*[F.col(c).cast("string") for c in days.columns])))
