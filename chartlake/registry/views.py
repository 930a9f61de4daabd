"""The given tables in the shape of chart data.

A line is a chart entry: its order is the track, its supplier the artist, the order
date the day. Nested documents are built row by row, with ``array`` and ``struct``,
so that no group of rows is ever collected into one. The ``*_SQL`` texts give the
same rows to the SQL checks; they never build arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.sinks.writers import rebalanced

SITE = "https://charts.example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _order_day() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order and supplier."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    suppliers = table(spark, sf_dir, "supplier")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        suppliers, lines.l_suppkey == suppliers.s_suppkey
    )


ENTRIES_SQL = """
    lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
"""


# --- flat tables -------------------------------------------------------------


def flat_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    return entries(spark, sf_dir).select(
        key.alias("id"),
        F.col("l_linenumber").alias("position"),
        F.col("o_orderdate").cast("date").alias("ranking_date"),
        F.col("l_suppkey").alias("artists_id"),
        F.col("s_name").alias("artists_name"),
        F.col("o_orderpriority").alias("album_name"),
        _order_day().alias("album_release_date"),
        (F.col("o_custkey") % 3 + 1).alias("disc_number"),
        (F.col("o_orderstatus") == "F").alias("explicit"),
        _text("Track ", key).alias("name"),
        _text(f"{SITE}/tracks/", key).alias("href"),
        (F.col("o_totalprice") < 50000).alias("is_local"),
        F.col("l_linenumber").cast("bigint").alias("track_number"),
        F.lit("track").alias("type"),
        _text("chart:track:", key).alias("uri"),
    )


FLAT_TRACKS_SQL = f"""
    SELECT l_orderkey AS id, l_linenumber AS "position",
           CAST(o_orderdate AS DATE) AS ranking_date,
           l_suppkey AS artists_id, s_name AS artists_name,
           o_orderpriority AS album_name,
           strftime(o_orderdate, '%Y-%m-%d') AS album_release_date,
           o_custkey % 3 + 1 AS disc_number, o_orderstatus = 'F' AS explicit,
           'Track ' || l_orderkey AS "name", '{SITE}/tracks/' || l_orderkey AS href,
           o_totalprice < 50000 AS is_local, CAST(l_linenumber AS BIGINT) AS track_number,
           'track' AS "type", 'chart:track:' || l_orderkey AS uri
    FROM {ENTRIES_SQL}
"""


def flat_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier")
    parts = table(spark, sf_dir, "part")
    key = F.col("s_suppkey")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            key.alias("id"),
            F.col("s_acctbal").alias("total"),
            F.col("p_brand").alias("genres"),
            F.col("s_name").alias("name"),
            _text(f"{SITE}/artists/", key).alias("href"),
            F.col("s_nationkey").alias("popularity"),
            F.lit("artist").alias("type"),
            _text("chart:artist:", key).alias("uri"),
        )
    )


FLAT_ARTISTS_SQL = f"""
    SELECT s_suppkey AS id, s_acctbal AS total, p_brand AS genres, s_name AS "name",
           '{SITE}/artists/' || s_suppkey AS href, s_nationkey AS popularity,
           'artist' AS "type", 'chart:artist:' || s_suppkey AS uri
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
"""


def _features(record_id: Column) -> list[Column]:
    price, customer = F.col("o_totalprice"), F.col("o_custkey")
    return [
        (price / 1024).cast("float").alias("acousticness"),
        (customer % 101).cast("float").alias("danceability"),
        (customer * 10).cast("int").alias("duration_ms"),
        price.cast("float").alias("energy"),
        record_id.alias("id"),
        (customer % 7).cast("float").alias("instrumentalness"),
        (customer % 11).cast("float").alias("liveness"),
        (customer % 60).cast("float").alias("loudness"),
        (customer % 2).cast("float").alias("mode"),
        (customer % 13).cast("float").alias("speechiness"),
        (customer % 17).cast("float").alias("valence"),
        (price / 4096).cast("float").alias("tempo"),
        (customer % 5).cast("int").alias("time_signature"),
    ]


def flat_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*_features(F.col("o_orderkey")))


_FEATURES_SQL = """
           CAST(o_totalprice / 1024 AS FLOAT) AS acousticness,
           CAST(o_custkey % 101 AS FLOAT) AS danceability,
           CAST(o_custkey * 10 AS INTEGER) AS duration_ms,
           CAST(o_totalprice AS FLOAT) AS energy,
           CAST(o_custkey % 7 AS FLOAT) AS instrumentalness,
           CAST(o_custkey % 11 AS FLOAT) AS liveness,
           CAST(o_custkey % 60 AS FLOAT) AS loudness,
           CAST(o_custkey % 2 AS FLOAT) AS "mode",
           CAST(o_custkey % 13 AS FLOAT) AS speechiness,
           CAST(o_custkey % 17 AS FLOAT) AS valence,
           CAST(o_totalprice / 4096 AS FLOAT) AS tempo,
           CAST(o_custkey % 5 AS INTEGER) AS time_signature"""

FLAT_FEATURES_SQL = f"""
    SELECT o_orderkey AS id, {_FEATURES_SQL}
    FROM orders
"""


# --- nested documents --------------------------------------------------------


def _artist_struct(record_id: Column, name: Column) -> Column:
    return F.struct(
        _text(f"{SITE}/artists/", record_id).alias("href"),
        record_id.alias("id"),
        name.alias("name"),
        F.lit("artist").alias("type"),
        _text("chart:artist:", record_id).alias("uri"),
    )


def _album_struct() -> Column:
    album_id = _text("AL", F.col("o_custkey"))
    return F.struct(
        F.col("o_orderpriority").alias("album_type"),
        _text(f"{SITE}/albums/", album_id).alias("href"),
        album_id.alias("id"),
        _text("Album ", F.col("o_custkey")).alias("name"),
        _order_day().alias("release_date"),
        (F.col("o_custkey") % 20).alias("total_tracks"),
        _text("chart:album:", album_id).alias("uri"),
    )


def _track_fields(key: Column) -> list[Column]:
    return [
        (F.col("o_custkey") % 3 + 1).alias("disc_number"),
        (F.col("o_custkey") * 10).alias("duration_ms"),
        (F.col("o_orderstatus") == "F").alias("explicit"),
        F.struct(_text("ISRC", key).alias("isrc")).alias("external_ids"),
        F.struct(_text(f"{SITE}/t/", key).alias("spotify")).alias("external_urls"),
        _text(f"{SITE}/tracks/", key).alias("href"),
        key.cast("string").alias("id"),
        (F.col("o_totalprice") < 50000).alias("is_local"),
        _text("Track ", key).alias("name"),
        (F.col("o_custkey") % 100).alias("popularity"),
        F.when(F.col("o_orderstatus") != "P", _text(f"{SITE}/p/", key)).alias("preview_url"),
        F.lit("track").alias("type"),
        _text("chart:track:", key).alias("uri"),
    ]


def track_docs(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """One document per line: one or two artists or none, up to three markets.

    Lines numbered 7 carry a day that does not exist. With ``by_day`` the documents of one
    day are brought together, while they are still narrow rows.
    """
    quantity = F.col("l_quantity")
    artists = F.array_compact(
        F.array(
            _artist_struct(_text("S", F.col("l_suppkey")), F.col("s_name")),
            F.when(
                F.col("o_orderstatus") == "P",
                _artist_struct(
                    _text("C", F.col("o_custkey")), _text("Customer ", F.col("o_custkey"))
                ),
            ),
        )
    )
    markets = F.array_compact(
        F.array(
            F.when(quantity >= 5, F.col("l_returnflag")),
            F.when(quantity >= 10, F.col("l_linestatus")),
            F.when(quantity >= 40, F.lit("X")),
        )
    )
    day = F.when(F.col("l_linenumber") == 7, "2022-13-40").otherwise(_order_day())
    lines = entries(spark, sf_dir).withColumn("date_ranking", day)
    if by_day:
        lines = rebalanced(lines, "date_ranking")
    return lines.select(
        _album_struct().alias("album"),
        F.when(F.col("l_tax") > 0, artists).alias("artists"),
        markets.alias("available_markets"),
        "date_ranking",
        *_track_fields(F.col("l_orderkey")),
        F.col("l_linenumber").cast("bigint").alias("position"),
        F.col("l_linenumber").cast("bigint").alias("track_number"),
    )


_TRACK_FIELDS_SQL = f"""
           o_custkey % 3 + 1 AS disc_number, o_custkey * 10 AS duration_ms,
           o_orderstatus = 'F' AS explicit, 'ISRC' || o_orderkey AS isrc,
           '{SITE}/t/' || o_orderkey AS spotify, '{SITE}/tracks/' || o_orderkey AS href,
           CAST(o_orderkey AS VARCHAR) AS id, o_totalprice < 50000 AS is_local,
           'Track ' || o_orderkey AS "name", o_custkey % 100 AS popularity,
           CASE WHEN o_orderstatus <> 'P' THEN '{SITE}/p/' || o_orderkey END AS preview_url,
           'track' AS "type", 'chart:track:' || o_orderkey AS uri"""

_ALBUM_SQL = f"""
           o_orderpriority AS album_type, '{SITE}/albums/AL' || o_custkey AS album_href,
           'AL' || o_custkey AS album_id, 'Album ' || o_custkey AS album_name,
           strftime(o_orderdate, '%Y-%m-%d') AS album_release_date,
           o_custkey % 20 AS album_total_tracks, 'chart:album:AL' || o_custkey AS album_uri"""

# Lines times the artists and markets that their document lists.
TRACK_DOCS_SQL = f"""
    SELECT {_ALBUM_SQL}, {_TRACK_FIELDS_SQL},
           CAST(l_linenumber AS BIGINT) AS "position",
           CAST(l_linenumber AS BIGINT) AS track_number,
           CASE WHEN l_linenumber <> 7
                THEN CAST(o_orderdate AS DATE) END AS ranking_date,
           l_quantity, l_returnflag, l_linestatus, l_tax, l_suppkey, s_name, o_custkey,
           o_orderstatus
    FROM {ENTRIES_SQL}
"""
# A tax is never null, so "no artists" is exactly l_tax <= 0.
DOC_ARTISTS_SQL = """
    (VALUES (1), (2)) AS artist(n)
"""
DOC_MARKETS_SQL = """
    (VALUES (1), (2), (3)) AS market(n)
"""
HAS_ARTIST_SQL = "(l_tax > 0 AND (artist.n = 1 OR o_orderstatus = 'P'))"
HAS_MARKET_SQL = """((market.n = 1 AND l_quantity >= 5) OR (market.n = 2 AND l_quantity >= 10)
            OR (market.n = 3 AND l_quantity >= 40))"""
ARTIST_ID_SQL = "CASE artist.n WHEN 1 THEN 'S' || l_suppkey ELSE 'C' || o_custkey END"
ARTIST_NAME_SQL = "CASE artist.n WHEN 1 THEN s_name ELSE 'Customer ' || o_custkey END"
MARKET_SQL = "CASE market.n WHEN 1 THEN l_returnflag WHEN 2 THEN l_linestatus ELSE 'X' END"


def artist_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per supplier: up to three genres, one to three images.

    Suppliers of nation 9 have no genre list at all.
    """
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    key = _text("S", F.col("s_suppkey"))

    def image(size: int) -> Column:
        return F.struct(
            F.lit(size).cast("bigint").alias("height"),
            _text(f"{SITE}/i/", key, f"/{size}").alias("url"),
            F.lit(size).cast("bigint").alias("width"),
        )

    genres = F.array_compact(
        F.array(
            F.when(F.col("s_nationkey") != 3, F.col("n_name")),
            F.when(F.col("s_acctbal") > 2000, F.col("r_name")),
            F.when(F.col("s_acctbal") > 5000, F.lit("gold")),
        )
    )
    images = F.array_compact(
        F.array(
            image(64),
            F.when(F.col("s_nationkey") > 5, image(300)),
            F.when(F.col("s_nationkey") > 15, image(640)),
        )
    )
    return (
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select(
            F.struct(_text(f"{SITE}/a/", key).alias("spotify")).alias("external_urls"),
            F.struct(F.floor("s_acctbal").alias("total")).alias("followers"),
            F.when(F.col("s_nationkey") != 9, genres).alias("genres"),
            _text(f"{SITE}/artists/", key).alias("href"),
            key.alias("id"),
            images.alias("images"),
            F.col("s_name").alias("name"),
            F.col("s_nationkey").cast("bigint").alias("popularity"),
            F.lit("artist").alias("type"),
            _text("chart:artist:", key).alias("uri"),
        )
    )


ARTIST_DOCS_SQL = f"""
    SELECT '{SITE}/a/S' || s_suppkey AS spotify, CAST(floor(s_acctbal) AS BIGINT) AS total,
           CASE genre.n WHEN 1 THEN n_name WHEN 2 THEN r_name ELSE 'gold' END AS genres,
           '{SITE}/artists/S' || s_suppkey AS href, 'S' || s_suppkey AS id,
           CAST(size.n AS BIGINT) AS height, '{SITE}/i/S' || s_suppkey || '/' || size.n AS url,
           CAST(size.n AS BIGINT) AS width, s_name AS "name",
           CAST(s_nationkey AS BIGINT) AS popularity, 'artist' AS "type",
           'chart:artist:S' || s_suppkey AS uri
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey,
         (VALUES (1), (2), (3)) AS genre(n), (VALUES (64), (300), (640)) AS size(n)
    WHERE s_nationkey <> 9
      AND ((genre.n = 1 AND s_nationkey <> 3) OR (genre.n = 2 AND s_acctbal > 2000)
           OR (genre.n = 3 AND s_acctbal > 5000))
      AND (size.n = 64 OR (size.n = 300 AND s_nationkey > 5) OR (size.n = 640 AND s_nationkey > 15))
"""


def feature_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature record per order, with all columns of the fixed schema."""
    return _feature_docs(table(spark, sf_dir, "orders"))


def _feature_docs(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.select(
        *_features(key.cast("string")),
        _text(f"{SITE}/analysis/", key).alias("analysis_url"),
        (F.col("o_custkey") % 12).cast("int").alias("key"),
        _text(f"{SITE}/tracks/", key).alias("track_href"),
        F.lit("audio_features").alias("type"),
        _text("chart:track:", key).alias("uri"),
    )


FEATURE_DOCS_SQL = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, {_FEATURES_SQL},
           '{SITE}/analysis/' || o_orderkey AS analysis_url,
           CAST(o_custkey % 12 AS INTEGER) AS "key", '{SITE}/tracks/' || o_orderkey AS track_href,
           'audio_features' AS "type", 'chart:track:' || o_orderkey AS uri
    FROM orders
"""


# --- lookups and snapshots of the landing jobs -------------------------------


def lookup_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One track record per order, by one or two customers."""

    def customer(number: Column) -> Column:
        return _artist_struct(_text("C", number), _text("Customer ", number))

    artists = F.array_compact(
        F.array(
            customer(F.col("o_custkey")),
            F.when(F.col("o_orderstatus") == "P", customer(F.col("o_custkey") + 1)),
        )
    )
    return table(spark, sf_dir, "orders").select(
        _album_struct().alias("album"),
        artists.alias("artists"),
        F.array(F.col("o_orderstatus")).alias("available_markets"),
        *_track_fields(F.col("o_orderkey")),
        (F.col("o_custkey") % 20).alias("track_number"),
    )


def lookup_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature records; orders of low priority have none."""
    return _feature_docs(table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'"))


def lookup_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One artist record per customer."""
    key = _text("C", F.col("c_custkey"))
    return table(spark, sf_dir, "customer").select(
        F.struct(_text(f"{SITE}/a/", key).alias("spotify")).alias("external_urls"),
        F.struct(F.floor("c_acctbal").alias("total")).alias("followers"),
        F.array("c_mktsegment").alias("genres"),
        _text(f"{SITE}/artists/", key).alias("href"),
        key.alias("id"),
        F.array(
            F.struct(
                F.lit(64).cast("bigint").alias("height"),
                _text(f"{SITE}/i/", key).alias("url"),
                F.lit(64).cast("bigint").alias("width"),
            )
        ).alias("images"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("popularity"),
        F.lit("artist").alias("type"),
        _text("chart:artist:", key).alias("uri"),
    )


# Columns that order snapshots taken at the same time.
SNAPSHOT_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def daily_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per line, listing three tracks and sometimes one that is unknown."""

    def item(track_id: Column) -> Column:
        return F.struct(F.struct(track_id.cast("string").alias("id")).alias("track"))

    return table(spark, sf_dir, "lineitem").select(
        *SNAPSHOT_ORDER,
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("taken_at"),
        F.array_compact(
            F.array(
                item(F.col("l_orderkey")),
                item(F.col("l_partkey")),
                F.when(F.col("l_returnflag") == "R", item(F.lit("gone"))),
                item(F.col("l_suppkey")),
            )
        ).alias("items"),
    )


def history_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archived snapshot per line; its tracks were added on or after its day."""

    def entry(track_id: Column, days: Column) -> Column:
        added = F.date_add(F.col("l_shipdate").cast("date"), days)
        return F.struct(
            _text(f"{SITE}/track/", track_id, "?si=", F.col("l_linenumber")).alias("url"),
            _text(F.date_format(added, "yyyy-MM-dd"), "T05:00:00Z").alias("added_at"),
        )

    return table(spark, sf_dir, "lineitem").select(
        *SNAPSHOT_ORDER,
        F.col("l_shipdate").alias("snapshot_day"),
        F.array(
            entry(F.col("l_orderkey"), F.lit(0)),
            entry(F.col("l_partkey"), F.col("l_linenumber")),
            entry(F.col("l_suppkey"), F.lit(2)),
        ).alias("tracks"),
    )
