"""Widened scans, partition sync, replacement, bitmaps, buckets, rejects, drift, stream batches."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.plans import jobs
from chartlake.sinks import bitmaps, catalog
from chartlake.sinks.bitmaps import append_by_bitmap, bitmap_path, holds, key_bitmaps
from chartlake.sinks.bucketed import append_bucketed, unseen_ids
from chartlake.sinks.catalog import add_days, append_and_register, create_database, register_table
from chartlake.sinks.incremental import incremental_append
from chartlake.sinks.replace import best_fit, compact, replace_newer, replace_table
from chartlake.sinks.writers import append_parquet
from chartlake.sources.drift import check_drift, drift_rows, fields_of, variant_type
from chartlake.sources.readers import read_parquet
from chartlake.sources.rejects import scan_with_rejects
from chartlake.sources.widening import common_schema, read_widened, stored_schemas, wider
from chartlake.streaming.ingest import append_batch, append_new_files

D = [date(2022, 4, n) for n in range(1, 10)]


def placed(spark, *values):
    return spark.createDataFrame(list(values), "position BIGINT, ranking_date DATE, v STRING")


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found[full] = os.stat(full).st_mtime_ns
    return found


# --- widening -------------------------------------------------------------------


@pytest.mark.parametrize("a,b,both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"),
    ("bigint", "float", "double"), ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(10,9)", "double"),
    ("decimal(4,3)", "decimal(6,1)", "decimal(8,3)"), ("double", "decimal(4,1)", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("date", "timestamp", "timestamp"), ("string", "int", "string"), ("boolean", "int", "string"), ("void", "date", "date"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("struct<a:int>", "int", "string"),
    ("decimal(4,1)", "string", "string"),
])
def test_wider_types(spark, a, b, both):
    kind = lambda text: T.StructType.fromDDL(f"x {text}")["x"].dataType
    assert wider(kind(a), kind(b)).simpleString() == both
    assert wider(kind(b), kind(a)).simpleString().replace("b:string,a:bigint", "a:bigint,b:string") == both


def test_common_schema_compares_names_without_case(spark):
    schemas = [T.StructType.fromDDL("Id INT NOT NULL, a FLOAT"), T.StructType.fromDDL("id BIGINT, B STRING")]
    assert common_schema(schemas).simpleString() == "struct<Id:bigint,a:float,B:string>"


def test_folders_that_merge_are_read_as_ever(spark, tmp_path):
    path = str(tmp_path)
    spark.range(2).write.parquet(f"{path}/batch=1")
    spark.range(2).withColumn("extra", F.lit("x")).write.parquet(f"{path}/batch=2")
    assert rows(read_widened(spark, path), "id", "extra", "batch") == [
        (0, None, 1), (0, "x", 2), (1, None, 1), (1, "x", 2),
    ]


def test_widening_without_and_with_casts(spark, tmp_path):
    path = str(tmp_path / "narrow")
    spark.sql("select 1 as n, cast(1.5 as float) as f, struct(1 as a) as s").write.parquet(f"{path}/batch=1")
    spark.sql("select 5000000000 as n, 2.25D as f, struct(7000000000 as a) as s").write.parquet(f"{path}/batch=2")
    wide = read_widened(spark, path)
    assert wide.dtypes == [("n", "bigint"), ("f", "double"), ("s", "struct<a:bigint>"), ("batch", "int")]
    assert [tuple(r) for r in wide.orderBy("n").collect()] == [(1, 1.5, (1,), 1), (5000000000, 2.25, (7000000000,), 2)]
    spark.sql("select 'x' as n, timestamp_ntz'2022-04-01 05:00:00' as t").write.parquet(f"{path}/batch=3")
    spark.sql("select 12.50BD as n, date'2022-04-02' as t").write.parquet(f"{path}/batch=4")
    mixed = read_widened(spark, path)
    assert dict(mixed.dtypes)["n"] == "string" and dict(mixed.dtypes)["t"] == "timestamp_ntz"
    got = {r["batch"]: (r["n"], r["f"], r["t"]) for r in mixed.collect()}
    assert got == {
        1: ("1", 1.5, None), 2: ("5000000000", 2.25, None), 3: ("x", None, datetime(2022, 4, 1, 5)),
        4: ("12.50", None, datetime(2022, 4, 2)),
    }


def test_files_of_one_folder_that_differ_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "one folder")
    spark.range(2).select(F.col("id").cast("int").alias("id")).coalesce(1).write.parquet(path)
    spark.range(5, 7).coalesce(1).write.mode("append").parquet(path)
    assert len(stored_schemas(spark, path)) == 2
    assert rows(read_widened(spark, path)) == [(0,), (1,), (5,), (6,)]


def test_a_table_of_widened_files_is_registered(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, kind in ((1, "int"), (2, "bigint")):
        spark.range(1).select(F.lit(n).cast(kind).alias("n")).write.parquet(f"{path}/ranking_date=2022-04-0{n}")
    create_database(spark, "widened", str(tmp_path / "db"))
    register_table(spark, "widened", "t", path, "ranking_date")
    assert rows(spark.table("widened.t")) == [(1, D[0]), (2, D[1])]
    assert dict(spark.table("widened.t").dtypes)["n"] == "bigint"


# --- partition sync ---------------------------------------------------------------


def test_only_written_days_are_registered(spark, tmp_path):
    path = str(tmp_path / "fact")
    create_database(spark, "synced", str(tmp_path / "db"))
    first = placed(spark, (1, D[0], "a"), (1, None, "n"), (2, D[0], "b"))
    assert append_and_register(first, "synced", "fact", path, "ranking_date") == [D[0], None]
    append_parquet(placed(spark, (1, D[5], "other job")), path, "ranking_date")
    assert append_and_register(placed(spark, (1, D[1], "c")), "synced", "fact", path, "ranking_date") == [D[1]]
    assert append_and_register(placed(spark).limit(0), "synced", "fact", path, "ranking_date") == []
    assert rows(spark.table("synced.fact"), "v") == [("a",), ("b",), ("c",), ("n",)]
    register_table(spark, "synced", "fact", path, "ranking_date")
    assert spark.table("synced.fact").count() == 5


def test_days_are_added_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "BATCH_DAYS", 2)
    path = str(tmp_path / "fact")
    append_parquet(placed(spark, *[(1, d, "a") for d in D]), path, "ranking_date")
    create_database(spark, "batches", str(tmp_path / "db"))
    register_table(spark, "batches", "fact", path, "ranking_date")
    assert spark.table("batches.fact").count() == len(D)
    assert add_days(spark, "batches", "fact", "ranking_date", [D[0], D[0], "2023-01-01"]) == 2
    assert spark.sql("show partitions batches.fact").count() == len(D) + 1


def test_a_fact_job_registers_the_days_that_it_writes(spark, tmp_path):
    root = str(tmp_path)

    def entries(*values):
        names = ["id", "position", "ranking_date", "artists_name"]
        return spark.createDataFrame(list(values), "id STRING, position BIGINT, ranking_date DATE, artists_name STRING").select(*names)

    append_parquet(entries(("t", 1, D[0], "a"), ("t", 2, D[1], "b")), f"{root}/ref/tracks", "ranking_date")
    jobs.f_ranking(spark, root, database="job_days")
    catalog.register_exports(spark, f"{root}/exp", "job_days", ["f_ranking"], database_location=str(tmp_path / "db"))
    append_parquet(entries(("t", 1, D[2], "c"), ("t", 1, D[0], "late")), f"{root}/ref/tracks", "ranking_date")
    jobs.f_ranking(spark, root, database="job_days")
    assert rows(spark.table("job_days.f_ranking"), "ranking_date", "artist") == [(D[0], "a"), (D[1], "b"), (D[2], "c")]
    assert spark.sql("show partitions job_days.f_ranking").count() == 3
    for n in range(5):
        append_parquet(entries(("u", 10 + n, D[0], "x")), f"{root}/ref/tracks", "ranking_date")
    before = rows(read_parquet(spark, f"{root}/ref/tracks"))
    jobs.compact_days(spark, root)
    assert rows(read_parquet(spark, f"{root}/ref/tracks")) == before
    assert len([f for f in files(f"{root}/ref/tracks") if str(D[0]) in f]) == 1


def test_jobs_for_rejects_and_drift(spark, tmp_path, capsys):
    good = {"tracks": '{"id": "1", "position": 1}', "tracks_features": '{"id": "1", "tempo": 1.5}', "artists": '{"id": "a"}'}
    for run, lines in (("2022-04-01T000000", good), ("2022-04-02T000000", good | {"artists": '{"id": 5, "kind": "x"}\nbroken'})):
        for kind, text in lines.items():
            folder = tmp_path / "raw" / kind / f"run={run}"
            folder.mkdir(parents=True)
            (folder / "1.json").write_text(text + "\n")
    for run in ("2022-04-01 00:00:00", "2022-04-02 00:00:00"):
        jobs.landed_rejects(spark, str(tmp_path), run)
        jobs.landed_drift(spark, str(tmp_path), run)
    said = capsys.readouterr().out
    assert "artists: 2 lines, 1 rejected" in said and "artists.id: retyped (string -> bigint)" in said
    assert "artists.kind: new (None -> string)" in said and said.count("retyped") == 1
    kept = read_parquet(spark, str(tmp_path / "rejects" / "artists"))
    assert rows(kept, "record") == [("broken",)]


def test_several_tasks_write_many_small_days(spark, tmp_path):
    days = spark.range(0, 4000, 1, 4).select(F.col("id").alias("v"), F.expr("date_add(date'2020-01-01', cast(id % 400 as int))").alias("d"))
    path = tmp_path / "days"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", None)
    append_parquet(days, str(path), partition_by="d")
    tasks = {name.split("-")[1] for name in map(os.path.basename, files(path))}
    assert len(tasks) >= 4 and len(files(path)) == 400
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", None) == before


# --- replacement -------------------------------------------------------------------


def versions(spark, *values):
    return spark.createDataFrame(list(values), "position BIGINT, ranking_date DATE, run INT, v STRING")


def test_newer_rows_replace_older_ones_and_other_days_keep_their_files(spark, tmp_path):
    path, keys = str(tmp_path / "docs"), ["position", "ranking_date"]
    start = [(p, d, 1, f"{p}") for p in (1, 2) for d in D[:4]]
    replace_newer(versions(spark, *start, (1, D[0], 0, "old copy")), path, keys, ["run"], "ranking_date")
    before = files(path)
    batch = [(1, D[1], 2, "new"), (1, D[2], 0, "late"), (2, D[3], 1, "tie"), (7, D[8], 1, "added"), (7, D[8], 2, "last")]
    replace_newer(versions(spark, *batch), path, keys, ["run"], "ranking_date")
    want = [(p, d, 1, f"{p}") for p in (1, 2) for d in D[:4] if (p, d) != (1, D[1])] + [(1, D[1], 2, "new"), (7, D[8], 2, "last")]
    assert rows(read_parquet(spark, path), "position", "ranking_date", "run", "v") == sorted(want)
    after = files(path)
    kept = {f: t for f, t in before.items() if str(D[1]) not in f}
    assert kept.items() <= after.items() and len(after) == len(before) + 1
    replace_newer(versions(spark, *batch, *start), path, keys, ["run"], "ranking_date")
    assert files(path) == after


def test_rows_without_a_key_stay_beside_each_other(spark, tmp_path):
    path, keys = str(tmp_path / "docs"), ["position", "ranking_date"]
    for _ in range(2):
        replace_newer(versions(spark, (None, D[0], 1, "a"), (1, None, 1, "b"), (1, D[0], 1, "c")), path, keys, ["run"], "ranking_date")
    assert rows(read_parquet(spark, path), "v") == [("a",), ("a",), ("b",), ("b",), ("c",)]
    with pytest.raises(ValueError):
        replace_newer(versions(spark), path, ["position"], ["run"], "ranking_date")


def test_compaction_rewrites_only_days_of_many_files(spark, tmp_path):
    path = str(tmp_path / "a b" / "scattered")
    for n in range(5):
        append_parquet(placed(spark, (n, D[0], "x"), (n, None, "y")), path, "ranking_date")
    append_parquet(placed(spark, (9, D[1], "z")), path, "ranking_date")
    before, table = files(path), rows(read_parquet(spark, path))
    assert compact(spark, path, "ranking_date", max_files=3) == 2
    after = files(path)
    assert len(after) == 3 and rows(read_parquet(spark, path)) == table
    assert {f for f in before if str(D[1]) in f} <= set(after)
    assert compact(spark, path, "ranking_date", max_files=3) == 0 and files(path) == after


def test_files_are_packed_largest_first():
    import pandas as pd

    sizes = [50, 40, 40, 30, 30, 20, 120, 100]
    packed = best_fit(100)(pd.DataFrame({"file": [f"f{i}" for i in range(8)], "bytes": sizes, "day": 1}))
    fill = packed.groupby("bin")["bytes"].sum().tolist()
    assert sorted(fill) == [20, 90, 100, 100, 120]


def test_a_table_is_replaced_by_a_job_that_reads_it(spark, tmp_path):
    create_database(spark, "switched", str(tmp_path / "db"))
    root = str(tmp_path / "versions")
    first = replace_table(spark.range(5), "switched", "t", root)
    old = spark.table("switched.t")
    second = replace_table(spark.table("switched.t").filter("id > 1"), "switched", "t", root)
    assert first != second and rows(spark.table("switched.t")) == [(2,), (3,), (4,)]
    assert rows(read_parquet(spark, first)) == rows(old) == [(n,) for n in range(5)]
    with pytest.raises(Exception):
        replace_table(spark.table("switched.t").select(F.raise_error(F.lit("late")).cast("long").alias("id")), "switched", "t", root)
    assert spark.table("switched.t").count() == 3
    replace_table(spark.table("switched.t").withColumn("w", F.lit("x")), "switched", "t", root)
    assert spark.table("switched.t").columns == ["id", "w"] and spark.table("switched.t").count() == 3
    append_and_register(placed(spark, (1, D[0], "a")), "switched", "by_day", str(tmp_path / "d"), "ranking_date")
    with pytest.raises(ValueError):
        replace_table(spark.table("switched.by_day"), "switched", "by_day", root)


# --- bitmaps and buckets --------------------------------------------------------------


def test_bits_say_which_positions_a_day_has(spark):
    own = [0, 1, 7, 8, 9, 32767, 32768, 32769, 70000, -5]
    days = key_bitmaps(placed(spark, *[(n, D[0], "") for n in own], (None, D[0], "")), "position", "ranking_date")
    asked = spark.range(-40, 70100).select(
        "id", F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit")
    )
    found = asked.join(days, "bucket").filter(holds(F.col("bits"), F.col("bit")))
    assert rows(found, "id") == [(n,) for n in sorted(own)]


def test_bitmaps_give_the_rows_of_incremental_append(spark, tmp_path):
    batches = [
        [(1, D[0], "a"), (2, D[0], "b"), (2, D[0], "copy"), (None, D[0], "n"), (5, None, "m")],
        [(1, D[0], "late"), (3, D[0], "c"), (40000, D[0], "far"), (1, D[1], "d"), (None, D[0], "n"), (5, None, "m")],
        [(40000, D[0], "again"), (40001, D[0], "near"), (3, D[1], "e")],
        [],
    ]
    one, other = str(tmp_path / "bitmap"), str(tmp_path / "joined")
    for batch in batches:
        frame = placed(spark, *batch) if batch else placed(spark, (1, D[0], "x")).limit(0)
        append_by_bitmap(frame, one, "position", "ranking_date")
        incremental_append(frame, other, ["position", "ranking_date"], partition_by="ranking_date")
        assert rows(read_parquet(spark, one)) == rows(read_parquet(spark, other))


def test_the_probe_reads_bitmaps_and_not_the_table(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "t"), []
    append_by_bitmap(placed(spark, (1, D[0], "a")), path, "position", "ranking_date")
    true = bitmaps.staged

    def watched(df, name, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return true(df, name, **more)

    monkeypatch.setattr(bitmaps, "staged", watched)
    read = []
    monkeypatch.setattr(bitmaps, "unseen_by_bitmap", lambda b, own, *a, f=bitmaps.unseen_by_bitmap: read.append(f(b, own, *a)) or read[0])
    append_by_bitmap(placed(spark, (1, D[0], "b"), (2, D[0], "c")), path, "position", "ranking_date")
    assert len(read) == 1 and not any(f.startswith(f"file:{path}/") for f in read[0].inputFiles())
    assert rows(read_parquet(spark, path), "v") == [("a",), ("c",)]


def test_lost_bitmaps_are_made_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    append_by_bitmap(placed(spark, (1, D[0], "a")), path, "position", "ranking_date")
    append_parquet(placed(spark, (2, D[0], "rows without bitmaps")), path, "ranking_date")
    append_by_bitmap(placed(spark, (2, D[0], "late"), (3, D[0], "c")), path, "position", "ranking_date")
    assert rows(read_parquet(spark, path), "position") == [(1,), (2,), (3,)]
    assert read_parquet(spark, bitmap_path(path)).agg(F.sum("rows")).first()[0] == 3


def test_bucketed_append_without_a_shuffle_of_the_table(spark, tmp_path):
    create_database(spark, "buckets", str(tmp_path / "db"))
    path = str(tmp_path / "t")
    frame = lambda *v: spark.createDataFrame(list(v), "id STRING, v STRING")
    append_bucketed(frame(("a", "1"), ("b", "1"), ("b", "copy"), (None, "1")), "buckets", "t", "id", path, buckets=4)
    append_bucketed(frame(("a", "2"), ("c", "2"), ("c", "copy"), (None, "2")), "buckets", "t", "id", buckets=16)
    assert rows(spark.table("buckets.t")) == sorted(
        [("a", "1"), ("b", "1"), ("b", "copy"), ("c", "2"), ("c", "copy"), (None, "1"), (None, "2")],
        key=lambda r: (r[0] is not None, r),
    )
    assert read_parquet(spark, path).count() == 7
    plan = unseen_ids(frame(("z", "1")), spark.table("buckets.t"), "id")._jdf.queryExecution().executedPlan().toString()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = plan.splitlines()
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = [x for x in lines[i + 1 :]]
            end = next((k for k, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            assert not any("FileScan" in x for x in below[:end])


# --- raw records -----------------------------------------------------------------------


def test_rejects_are_kept_with_their_file_and_counts(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"id": "1", "n": 5}\n{"id": "2", "n": "five"}\n{"id": "3"\n')
    (source / "b.json").write_text('{"id": "4", "other": [1]}\nnot json\n{"id": 6, "n": null}\n')
    scan = scan_with_rejects(spark, str(source), "id STRING, n INT")
    assert (scan.read, scan.rejected) == (6, 3)
    assert {r["id"]: r["n"] for r in scan.good.collect()} == {"1": 5, "4": None, "6": None}
    got = {r["record"]: (os.path.basename(r["file"]), r["part_read"]["id"]) for r in scan.rejects.collect()}
    assert set(got) == {'{"id": "2", "n": "five"}', '{"id": "3"', "not json"}
    assert got['{"id": "2", "n": "five"}'] == ("a.json", "2") and got["not json"][0] == "b.json"


def test_drift_between_landings(spark, tmp_path):
    stored = str(tmp_path / "schema")
    for n, lines in enumerate([
        ['{"id": "1", "a": {"b": 1, "c": [1.5]}, "gone": true}', '{"id": "2", "a": {"b": 20, "c": []}}'],
        ['{"id": 1, "a": {"b": "x", "d": null, "c": [2.25]}}', "not json"],
    ]):
        (tmp_path / f"{n}.json").write_text("\n".join(lines) + "\n")
    assert check_drift(spark, str(tmp_path / "0.json"), stored).collect() == []
    found = {r["field"]: (r["change"], r["before"], r["after"]) for r in check_drift(spark, str(tmp_path / "1.json"), stored).collect()}
    assert found == {
        "id": ("retyped", "string", "bigint"), "a.b": ("retyped", "bigint", "string"), "a.d": ("new", None, "void"),
        "gone": ("missing", "boolean", None),
    }
    assert check_drift(spark, str(tmp_path / "1.json"), stored).collect() == []


def test_variant_types_by_path(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ('{"a": "x", "l": [{"k": 2}]}',), (None,), ("bad",)], "value STRING")
    assert fields_of(variant_type(lines)) == {"a": "variant", "l": "list", "l[]": "object", "l[].k": "bigint"}
    assert fields_of(variant_type(lines.limit(0))) == {}
    assert drift_rows({"a": "int"}, {"a": "int"}) == []


# --- stream batches ---------------------------------------------------------------------


def test_a_repeated_batch_leaves_its_rows_once(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id STRING, v INT"
    frame = lambda *v: spark.createDataFrame(list(v), schema)
    first = frame(("a", 1), (None, 2), (None, 2), ("a", 3))
    for _ in range(2):
        append_batch(first, 0, path, ["id"])
    append_batch(frame(("a", 9), ("b", 4), (None, 5)), 1, path, ["id"])
    append_batch(first, 0, path, ["id"])
    append_batch(frame(("a", 9)), 2, path, ["id"])
    assert rows(read_parquet(spark, path), "id", "v") == [
        (None, 2), (None, 2), (None, 5), ("a", 1), ("a", 3), ("b", 4),
    ]


def test_a_stream_that_lost_its_checkpoint_repeats_nothing(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    (source / "1.json").write_text('{"id": "a", "v": 1}\n{"v": 2}\n')
    for n in range(2):
        append_new_files(spark, str(source), "id STRING, v INT", path, ["id"], str(tmp_path / f"c{n}")).awaitTermination()
    (source / "2.json").write_text('{"id": "a", "v": 3}\n{"id": "b", "v": 4}\n')
    append_new_files(spark, str(source), "id STRING, v INT", path, ["id"], str(tmp_path / "c1")).awaitTermination()
    assert rows(read_parquet(spark, path), "id", "v") == [(None, 2), ("a", 1), ("b", 4)]
