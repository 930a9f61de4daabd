"""Wide batches whose known keys are too many to be broadcast."""

from __future__ import annotations

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from chartlake.operators.joins import anti_join
from chartlake.plans import refine
from chartlake.schemas import TRACK_FEATURES
from chartlake.sinks import narrowing
from chartlake.sinks.staging import staged
from chartlake.sources.readers import byte_count, read_parquet

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def test_feature_records_are_not_shuffled_to_find_the_unseen(spark, setting, tmp_path, monkeypatch):
    setting(THRESHOLD, "40KB")
    path, plans, latest = str(tmp_path / "ref"), [], refine._latest

    def seen(new, kind, run):
        plans.append(final_plan(new))
        return latest(new, kind, run)

    monkeypatch.setattr(refine, "_latest", seen)
    docs = spark.range(40_000).select(
        F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("uri"),
        (F.col("id") % 2).cast("string").alias("run"),
    )
    few = docs.filter("CAST(id AS INT) < 10")
    docs = docs.unionByName(few.withColumns({"uri": F.lit("later"), "run": F.lit("2")}))
    docs = staged(docs, "docs")
    for batch in (docs.filter("run = '1'"), docs):
        refine.load_track_features(batch, path, run="run")
    assert "BroadcastHashJoin" in plans[1] and "SortMergeJoin" not in plans[1]
    loaded = read_parquet(spark, path, TRACK_FEATURES)
    assert loaded.count() == loaded.select("id").distinct().count() == 40_000
    # The odd ids of the first load stay as they were, the even ones are of the last run.
    assert rows(loaded.filter("uri = 'later'"), "id") == [(str(i),) for i in (0, 2, 4, 6, 8)]


@pytest.mark.parametrize("most_blocks", [1, narrowing.MOST_BLOCKS])
@pytest.mark.parametrize("null_safe", [False, True])
def test_narrowing_keeps_the_rows_of_the_anti_join(spark, monkeypatch, most_blocks, null_safe):
    monkeypatch.setattr(narrowing, "MOST_BLOCKS", most_blocks)
    batch = spark.range(60_000).selectExpr(
        "CASE WHEN id % 1000 <> 7 THEN CAST(id % 50000 AS STRING) END AS a",
        "CASE WHEN id % 900 <> 5 THEN id % 3 END AS b", "id AS n",
    )
    known = batch.filter("n % 2 = 0 OR a IS NULL").select("a", "b").distinct()
    known = staged(known, "known")
    few, needed = narrowing.narrowed(batch, known, ["a", "b"], null_safe)
    wanted = anti_join(batch, known, ["a", "b"], null_safe)
    assert rows(anti_join(few, needed, ["a", "b"], null_safe)) == rows(wanted)
    if most_blocks > 1:
        assert few.count() < wanted.count() * 1.02 and needed.count() < known.count() * 0.02


def test_narrowing_of_a_batch_without_new_rows(spark):
    known = staged(spark.range(1000).select("id"), "known")
    few, needed = narrowing.narrowed(spark.range(500).toDF("id"), known, ["id"])
    assert few.count() == needed.count() == 0


def test_what_is_too_many_to_broadcast(spark, setting):
    known = staged(spark.range(100_000).select("id"), "known")
    for most, too_many in (("100MB", False), ("1KB", True), ("-1", True)):
        setting(THRESHOLD, most)
        assert narrowing.too_many_to_broadcast(known) == too_many
    assert (byte_count("-1"), byte_count("10485760b"), byte_count("8m")) == (-1, 10 << 20, 8 << 20)
