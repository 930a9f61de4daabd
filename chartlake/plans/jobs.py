"""The jobs by name, over one lake root.

Layout under the root::

    snapshots/daily/taken=…   the chart snapshot of a daily run (JSON), by time of the run
    snapshots/history/snapshot_day=…   archived snapshots, one a file, named in time order
    lookup/{tracks,tracks_features,artists}   records by id (Parquet)
    raw/{tracks,tracks_features,artists}/run=…   landed documents (JSON)
    ref/{tracks,tracks_features,artists}   flat tables (Parquet)
    exp/{dim_artist,…}   dimensions and facts (Parquet)
    landing-zone/*.csv, processing/csv   the CSV job
    rejects/{tracks,…}/run=…, schemas/{tracks,…}   lines that did not fit, fields of the last run
    orders/*.json, processing/order_totals   the order total job
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.plans import extras, landing, marts, refine
from chartlake.schemas import (
    DAY,
    RAW_ARTISTS,
    RAW_TRACKS,
    SNAPSHOT_DAILY,
    SNAPSHOT_HISTORY,
    TRACK_FEATURES,
)
from chartlake.sinks.catalog import register_exports as _register
from chartlake.sinks.catalog import sync_days
from chartlake.sinks.preview import print_preview
from chartlake.sinks.replace import compact
from chartlake.sinks.staging import staged
from chartlake.sinks.writers import Days, overwrite_parquet
from chartlake.sources.drift import check_drift
from chartlake.sources.readers import path_exists, read_json, read_parquet
from chartlake.sources.rejects import scan_with_rejects

RAW = {"tracks": RAW_TRACKS, "tracks_features": TRACK_FEATURES, "artists": RAW_ARTISTS}
# The tables that are laid out by chart day.
BY_DAY = ("ref/tracks", "exp/f_artist", "exp/f_ranking", "exp/f_track_statistics")


def run_name(run: str) -> str:
    """The time of a run as it stands in folder names; such names sort in time order."""
    return run.replace(" ", "T").replace(":", "")


def land_daily(spark: SparkSession, root: str, run: str) -> None:
    """``run`` is the time of the run as ``yyyy-MM-dd HH:mm:ss``; it dates the chart.

    Only the snapshot taken by this run is read, so earlier ones keep their own day.
    """
    folder = f"{root}/snapshots/daily/taken={run_name(run)}"
    snapshots = read_json(spark, folder, SNAPSHOT_DAILY, True).withColumns(
        {"taken_at": F.lit(run).cast("timestamp_ntz"), "snapshot": F.col("_metadata.file_path")}
    )
    _land(spark, root, run, landing.daily_entries(snapshots, "taken_at"), ["taken_at", "snapshot"])


def land_history(
    spark: SparkSession,
    root: str,
    run: str,
    ranges: Sequence[tuple[str, str]] | None = None,
) -> None:
    """Archived snapshots of the wanted days, or of all days.

    Of snapshots of one day the later one, by file name, takes a place that both fill.
    """
    snapshots = read_json(
        spark,
        f"{root}/snapshots/history",
        f"{SNAPSHOT_HISTORY}, snapshot_day DATE",
        True,
    ).withColumn("snapshot", F.col("_metadata.file_path"))
    wanted = landing.in_ranges(snapshots, "snapshot_day", ranges) if ranges else snapshots
    _land(spark, root, run, landing.history_entries(wanted), ["snapshot_day", "snapshot"])


def _land(
    spark: SparkSession, root: str, run: str, entries: DataFrame, order: Sequence[str]
) -> None:
    landed = landing.land_entries(
        staged(entries, "entries"),
        read_parquet(spark, f"{root}/lookup/tracks"),
        read_parquet(spark, f"{root}/lookup/tracks_features"),
        read_parquet(spark, f"{root}/lookup/artists"),
        order,
    )
    landing.write_landed(landed, f"{root}/raw", run_name(run))


def ref_artists(
    spark: SparkSession,
    root: str,
    runs: Sequence[str] | None = None,
    outer: bool = False,
    dedupe: bool = False,
    null_safe: bool = False,
) -> None:
    """With ``runs`` only these landing runs are read; the earlier ones must be in ``ref``."""
    docs = landing.landed_documents(spark, f"{root}/raw", "artists", RAW_ARTISTS, runs)
    refine.load_artists(docs, f"{root}/ref/artists", outer, dedupe, "run", null_safe)


def ref_tracks(
    spark: SparkSession,
    root: str,
    runs: Sequence[str] | None = None,
    outer: bool = False,
    dedupe: bool = False,
    null_safe: bool = False,
) -> None:
    docs = landing.landed_documents(spark, f"{root}/raw", "tracks", RAW_TRACKS, runs)
    refine.load_tracks(docs, f"{root}/ref/tracks", outer, dedupe, "run", null_safe)


def ref_tracks_features(
    spark: SparkSession, root: str, runs: Sequence[str] | None = None
) -> None:
    docs = landing.landed_documents(spark, f"{root}/raw", "tracks_features", TRACK_FEATURES, runs)
    refine.load_track_features(docs, f"{root}/ref/tracks_features", run="run")


def dim_artist(spark: SparkSession, root: str) -> None:
    overwrite_parquet(marts.dim_artist(_ref(spark, root, "artists")), f"{root}/exp/dim_artist")


def dim_track(spark: SparkSession, root: str) -> None:
    overwrite_parquet(marts.dim_track(_ref(spark, root, "tracks")), f"{root}/exp/dim_track")


def f_artist(
    spark: SparkSession,
    root: str,
    since: str | None = None,
    null_safe: bool = False,
    database: str | None = None,
) -> None:
    """With ``since`` only chart days from then on are read and compared.

    With ``database`` the days that the load writes are added to the table registered there.
    """
    artists, tracks = _ref(spark, root, "artists"), _tracks(spark, root, since)
    _load_fact(
        spark, root, "f_artist", database,
        lambda path, days: marts.load_f_artist(artists, tracks, path, null_safe, days),
    )


def f_genre(spark: SparkSession, root: str) -> None:
    fact = marts.f_genre(_ref(spark, root, "artists"), _ref(spark, root, "tracks"))
    overwrite_parquet(fact, f"{root}/exp/f_genre")


def f_ranking(
    spark: SparkSession,
    root: str,
    since: str | None = None,
    null_safe: bool = False,
    database: str | None = None,
) -> None:
    tracks = _tracks(spark, root, since)
    _load_fact(
        spark, root, "f_ranking", database,
        lambda path, days: marts.load_f_ranking(tracks, path, null_safe, days),
    )


def f_track_statistics(
    spark: SparkSession,
    root: str,
    since: str | None = None,
    null_safe: bool = False,
    database: str | None = None,
) -> None:
    tracks, features = _tracks(spark, root, since), _ref(spark, root, "tracks_features")
    _load_fact(
        spark, root, "f_track_statistics", database,
        lambda path, days: marts.load_f_track_statistics(tracks, features, path, null_safe, days),
    )


def _load_fact(
    spark: SparkSession, root: str, name: str, database: str | None, load: Callable[[str, Days], None]
) -> None:
    days = Days(DAY)
    load(f"{root}/exp/{name}", days)
    if database:
        sync_days(spark, database, name, DAY, days)


def csv_to_parquet(spark: SparkSession, root: str, schema: str | None = None) -> None:
    extras.csv_to_parquet(spark, f"{root}/landing-zone", f"{root}/processing/csv", schema=schema)


def order_total(spark: SparkSession, root: str) -> None:
    """Each line of the files in ``orders`` is a JSON object of order values."""
    totals = extras.order_totals(spark.read.text(f"{root}/orders"), "value")
    overwrite_parquet(totals, f"{root}/processing/order_totals")
    print_preview(read_parquet(spark, f"{root}/processing/order_totals"))


def register_exports(spark: SparkSession, root: str, database: str = "tracks") -> None:
    _register(spark, f"{root}/exp", database, partition_by=DAY)


def compact_days(spark: SparkSession, root: str) -> None:
    """Put the small files of the tables by day together, day by day where there are many."""
    for table in BY_DAY:
        if path_exists(spark, f"{root}/{table}"):
            compact(spark, f"{root}/{table}", DAY)


def landed_rejects(spark: SparkSession, root: str, run: str) -> None:
    """Keep the lines of a landing run that do not fit, with their files, under ``rejects``."""
    for kind, schema in RAW.items():
        scan = scan_with_rejects(spark, f"{root}/raw/{kind}/run={run_name(run)}", schema)
        overwrite_parquet(
            scan.rejects.select("record", "file"), f"{root}/rejects/{kind}/run={run_name(run)}"
        )
        print(f"{kind}: {scan.read} lines, {scan.rejected} rejected")


def landed_drift(spark: SparkSession, root: str, run: str) -> None:
    """Print which fields of a landing run are new, missing or of another type than before."""
    for kind in RAW:
        landed = f"{root}/raw/{kind}/run={run_name(run)}"
        found = check_drift(spark, landed, f"{root}/schemas/{kind}")
        for row in found.collect():
            print(f"{kind}.{row['field']}: {row['change']} ({row['before']} -> {row['after']})")


def _ref(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_parquet(spark, f"{root}/ref/{table}")


def _tracks(spark: SparkSession, root: str, since: str | None) -> DataFrame:
    tracks = _ref(spark, root, "tracks")
    return tracks.filter(F.col(DAY) >= F.lit(since).cast("date")) if since else tracks


# In the order in which each job finds its inputs ready.
JOBS: dict[str, Callable[..., None]] = {
    "land_daily": land_daily,
    "land_history": land_history,
    "ref_artists": ref_artists,
    "ref_tracks": ref_tracks,
    "ref_tracks_features": ref_tracks_features,
    "dim_artist": dim_artist,
    "dim_track": dim_track,
    "f_artist": f_artist,
    "f_genre": f_genre,
    "f_ranking": f_ranking,
    "f_track_statistics": f_track_statistics,
    "csv_to_parquet": csv_to_parquet,
    "order_total": order_total,
    "register_exports": register_exports,
    "compact_days": compact_days,
    "landed_rejects": landed_rejects,
    "landed_drift": landed_drift,
}
