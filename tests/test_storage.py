from __future__ import annotations

from datetime import date

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from chartlake.plans.extras import csv_to_parquet
from chartlake.sinks.catalog import register_exports, register_table
from chartlake.sinks.incremental import incremental_append
from chartlake.sinks.preview import preview_rows, preview_schema, print_preview
from chartlake.sinks.staging import SETTING, shared_folder, staged
from chartlake.sinks.writers import (
    OverwriteOfInputError,
    append_parquet,
    overwrite_parquet,
    reads_from,
    write_json,
)
from chartlake.sources.readers import (
    partition_columns,
    path_exists,
    read_csv,
    read_json,
    read_parquet,
    read_parquet_if_exists,
)

DAY = date(2022, 4, 1)


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [(1, "a", DAY), (2, None, date(2022, 4, 2)), (3, "c", None)],
        "n INT, v STRING, ranking_date DATE",
    )


def test_json_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "json")
    write_json(frame, path, partition_by="ranking_date")
    back = read_json(spark, path, "n INT, v STRING, ranking_date DATE")
    assert rows(back) == rows(frame)


def test_csv_round_trip(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text("id,name,born,score\n1,\"Ann, B\",1990-01-02,1.5\n2,,1991-03-04,\n")
    inferred = read_csv(spark, str(source))
    assert inferred.dtypes == [
        ("id", "int"), ("name", "string"), ("born", "date"), ("score", "double"),
    ]
    path = str(tmp_path / "table")
    csv_to_parquet(spark, str(source), path)
    assert rows(read_parquet(spark, path)) == [
        (1, "Ann, B", date(1990, 1, 2), 1.5), (2, None, date(1991, 3, 4), None),
    ]
    given = read_csv(spark, str(source), "id BIGINT, name STRING, born STRING, score STRING")
    assert given.first()["born"] == "1990-01-02"


def test_partitioned_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "days")
    append_parquet(frame, path, partition_by="ranking_date")
    back = read_parquet(spark, path)
    assert back.columns == ["n", "v", "ranking_date"] and rows(back) == rows(frame)
    assert partition_columns(back) == ["ranking_date"]
    assert partition_columns(frame) == []


def test_a_large_day_is_written_by_several_tasks(spark, setting, tmp_path):
    """The rebalance splits the day that holds most rows and leaves the others whole."""
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    days = spark.range(0, 60_000, 1, 8).select(
        F.xxhash64("id").alias("v"),
        F.when(F.col("id") % 10 < 9, "2022-04-01").otherwise("2022-04-02").cast("date").alias("d"),
    )
    path = tmp_path / "days"
    append_parquet(days, str(path), partition_by="d")
    assert len(list((path / "d=2022-04-01").glob("*.parquet"))) > 2
    assert len(list((path / "d=2022-04-02").glob("*.parquet"))) <= 2
    assert read_parquet(spark, str(path)).count() == 60_000


def test_existence(spark, frame, tmp_path):
    path = tmp_path / "table"
    assert not path_exists(spark, str(path))
    path.mkdir()
    assert not path_exists(spark, str(path))
    overwrite_parquet(frame, str(path))
    assert path_exists(spark, str(path))


def test_other_failures_are_not_taken_for_a_missing_table(spark):
    with pytest.raises(Exception) as caught:
        read_parquet_if_exists(spark, "nosuchscheme://somewhere/table")
    assert not isinstance(caught.value, AnalysisException) or (
        caught.value.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
    )


def test_overwrite_of_an_input_is_refused(spark, frame, tmp_path):
    path = str(tmp_path / "my table")
    overwrite_parquet(frame, path)
    table = read_parquet(spark, path)
    for target in (path, path + "/", "file:" + path, str(tmp_path)):
        with pytest.raises(OverwriteOfInputError):
            overwrite_parquet(table.filter("n > 1"), target)
    assert rows(read_parquet(spark, path)) == rows(frame)
    assert not reads_from(table, path + "2")
    overwrite_parquet(table, str(tmp_path / "my table2"))


def test_append_to_the_table_being_read(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    append_parquet(frame, path)
    append_parquet(read_parquet(spark, path), path)
    assert read_parquet(spark, path).count() == 6


def test_incremental_append(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    for _ in range(2):
        incremental_append(frame, path, ["n", "ranking_date"], partition_by="ranking_date")
    assert rows(read_parquet(spark, path), "n") == [(1,), (2,), (3,), (3,)]
    incremental_append(
        frame, path, ["n", "ranking_date"], partition_by="ranking_date",
        days=frame.select("ranking_date"), null_safe=True,
    )
    assert read_parquet(spark, path).count() == 4


def test_finish_sees_only_unseen_rows(spark, tmp_path):
    path, seen = str(tmp_path / "table"), []

    def double(df):
        seen.append(df.count())
        return df.union(df)

    for n in (3, 5):
        incremental_append(spark.range(n).select("id"), path, ["id"], finish=double)
    assert seen == [3, 2] and read_parquet(spark, path).count() == 10


def test_preview(spark, frame, capsys):
    assert rows(preview_rows(frame, 2, order_by=["n"]), "n") == [(1,), (2,)]
    assert rows(preview_schema(frame)) == [
        (1, "n", "int"), (2, "v", "string"), (3, "ranking_date", "date"),
    ]
    print_preview(frame)
    shown = capsys.readouterr().out
    assert "ranking_date" in shown and "integer" in shown


def test_staged_table_lies_in_the_shared_folder(spark, frame):
    table = staged(frame, "frame")
    assert rows(table) == rows(frame)
    assert all(spark.conf.get(SETTING) in f for f in table.inputFiles())


def test_shared_folder_without_a_setting_is_in_the_warehouse():
    class Unset:
        class conf:
            @staticmethod
            def get(key, *default):
                return default[0] if default else "hdfs://store/warehouse/"

    assert shared_folder(Unset) == "hdfs://store/warehouse/_staging"


def test_a_cluster_without_a_shared_folder_is_refused():
    class Cluster:
        class conf:
            @staticmethod
            def get(key, *default):
                return {"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/home/x/warehouse"}.get(key, *default)

    with pytest.raises(ValueError):
        shared_folder(Cluster)


def test_scratch_tables_go_unless_they_are_still_read(spark, frame):
    from chartlake.sinks.staging import scratch

    with scratch(spark) as keep:
        gone = staged(frame, "gone")
        with scratch(spark) as keep_inner:
            inner = staged(frame, "inner")
            read_by_both = keep_inner(staged(inner.filter("n > 1"), "kept").filter("n < 9"))
        result = keep(read_by_both.select("n"))
    assert rows(result) == [(2,), (3,)]
    assert not path_exists(spark, gone.inputFiles()[0]) and not path_exists(spark, inner.inputFiles()[0])


def test_catalog(spark, frame, tmp_path):
    root = str(tmp_path)
    overwrite_parquet(frame.drop("ranking_date"), f"{root}/dim")
    append_parquet(frame.select("n", F.lit(1).alias("extra")), f"{root}/dim")
    append_parquet(frame, f"{root}/fact", partition_by="ranking_date")
    location = f"{root}/database"
    names = register_exports(
        spark, root, "test_exports", ["dim", "fact"], database_location=location
    )
    assert names == ["test_exports.dim", "test_exports.fact"]
    assert sorted(spark.table("test_exports.dim").columns) == ["extra", "n", "v"]
    assert spark.table("test_exports.dim").count() == 6
    assert rows(spark.table("test_exports.fact")) == rows(frame)
    append_parquet(
        frame.filter("n = 1").withColumn("ranking_date", F.lit("2022-05-01").cast("date")),
        f"{root}/fact",
        partition_by="ranking_date",
    )
    register_table(spark, "test_exports", "fact", f"{root}/fact", "ranking_date")
    assert spark.table("test_exports.fact").count() == 4
