"""Scalar functions and generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.functions import columns as C
from chartlake.operators.generators import explode_columns, rank_entries
from chartlake.operators.projections import leaves, prefixed
from chartlake.plans.extras import order_totals
from chartlake.plans.landing import in_ranges, record_key, tracks_key
from chartlake.plans.refine import ALBUM_FIELDS, ARTIST_FIELDS
from chartlake.registry import views as V
from chartlake.registry.base import query

RANGES = [("1995-01-01", "1995-12-31"), ("1997-03-01", "1997-03-31"), ("1998-06-01", "2000-01-31")]
LINKS = 'href="([^"]*)"'


@query(
    "parse_date",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS parsed,
           strftime(o_orderdate, '%Y-%m-%d') AS day_text
    FROM orders
    """,
)
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    day = C.day_text(moment)
    spoiled = F.when(F.col("o_orderstatus") == "P", F.lit("2022-13-40")).otherwise(day)
    return V.table(spark, sf_dir, "orders").select(
        "o_orderkey", C.parse_day(spoiled).alias("parsed"), day.alias("day_text")
    )


@query(
    "format_timestamp",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment FROM events",
)
def format_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "events").select(
        "event_id", C.timestamp_text(F.col("ts")).alias("moment")
    )


@query(
    "url_last_segment",
    "SELECT page_id, split_part(split_part(url, '/', -1), '?', 1) AS segment FROM pages",
)
def url_last_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "pages").select(
        "page_id", C.url_last_segment(F.col("url")).alias("segment")
    )


@query(
    "natural_key",
    """
    SELECT 'tracks/musica' || strftime(l_shipdate, '%Y-%m-%d') || l_linenumber || '.json' AS track,
           'artists/' || l_suppkey || '.json' AS artist
    FROM lineitem
    """,
)
def natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "lineitem").select(
        tracks_key(F.col("l_shipdate").cast("date"), F.col("l_linenumber")).alias("track"),
        record_key("artists", F.col("l_suppkey")).alias("artist"),
    )


@query(
    "json_roundtrip",
    """
    SELECT event_id, user_id, event_type, ts, value, CAST(props->>'k' AS DOUBLE) AS k FROM events
    """,
)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = C.to_json_text("event_id", "user_id", "event_type", F.col("ts").cast("string").alias("ts"), "value", "props")
    record = C.from_json_text(
        F.col("text"),
        "event_id BIGINT, user_id BIGINT, event_type STRING, ts STRING, value DOUBLE, props STRING",
    )
    return (
        V.table(spark, sf_dir, "events")
        .select(text.alias("text"))
        .select(record.alias("r"))
        .select(
            "r.event_id", "r.user_id", "r.event_type",
            F.col("r.ts").cast("timestamp_ntz").alias("ts"), "r.value",
            C.from_json_text(F.col("r.props"), "map<string,double>")["k"].alias("k"),
        )
    )


@query(
    "json_map_total",
    """
    SELECT l_orderkey, l_linenumber, total_order_value,
           format('{:.2f}', total_order_value) AS total_text
    FROM (SELECT l_orderkey, l_linenumber,
                 l_extendedprice + l_extendedprice * l_discount + l_tax AS total_order_value
          FROM lineitem)
    """,
)
def json_map_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = C.to_json_text(
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    lines = V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", text.alias("text")
    )
    return order_totals(lines, "text").drop("text")


def _page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit(LINKS), 1)
    return V.table(spark, sf_dir, "pages").select(
        "page_id",
        F.transform(
            links, lambda url: F.struct(url.alias("url"), F.length(url).alias("size"))
        ).alias("tracks"),
    )


@query(
    "snapshot_positions",
    f"""
    SELECT page_id, split_part(split_part(url, '/', -1), '?', 1) AS track_id,
           CAST(place AS INTEGER) AS "position"
    FROM (SELECT page_id, unnest(links) AS url, generate_subscripts(links, 1) AS place
          FROM (SELECT page_id, regexp_extract_all(html, '{LINKS}', 1) AS links FROM pages))
    """,
)
def snapshot_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_entries(_page_links(spark, sf_dir), "tracks", "entry").select(
        "page_id", C.url_last_segment(F.col("entry.url")).alias("track_id"), "position"
    )


@query(
    "array_pluck",
    f"""
    SELECT page_id, array_to_string(regexp_extract_all(html, '{LINKS}', 1), ' ') AS urls
    FROM pages
    """,
)
def array_pluck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_links(spark, sf_dir).select(
        "page_id", C.joined(C.pluck(F.col("tracks"), "url"), " ").alias("urls")
    )


@query(
    "date_ranges",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS "day" FROM orders
    WHERE """
    + " OR ".join(f"CAST(o_orderdate AS DATE) BETWEEN '{lo}' AND '{hi}'" for lo, hi in RANGES),
)
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_ranges(V.table(spark, sf_dir, "orders"), "o_orderdate", RANGES).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )


@query(
    "explode_scalars",
    "SELECT vec_id, label, unnest(embedding) AS embedding FROM embeddings",
)
def explode_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_columns(
        V.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), ["embedding"]
    )


@query(
    "explode_structs",
    f"""
    SELECT id, "position", {V.ARTIST_ID_SQL} AS artists_id, {V.ARTIST_NAME_SQL} AS artists_name,
           'artist' AS artists_type, '{V.SITE}/artists/' || {V.ARTIST_ID_SQL} AS artists_href,
           'chart:artist:' || {V.ARTIST_ID_SQL} AS artists_uri
    FROM ({V.TRACK_DOCS_SQL}), {V.DOC_ARTISTS_SQL} WHERE {V.HAS_ARTIST_SQL}
    """,
)
def explode_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.track_docs(spark, sf_dir)
    return explode_columns(docs, ["artists"]).select(
        "id", "position", *prefixed("artists", ARTIST_FIELDS)
    )


@query(
    "explode_two",
    f"""
    SELECT id, "position", {V.ARTIST_ID_SQL} AS artist, {V.MARKET_SQL} AS market
    FROM ({V.TRACK_DOCS_SQL}), {V.DOC_ARTISTS_SQL}, {V.DOC_MARKETS_SQL}
    WHERE {V.HAS_ARTIST_SQL} AND {V.HAS_MARKET_SQL}
    """,
)
def explode_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.track_docs(spark, sf_dir)
    return explode_columns(docs, ["artists", "available_markets"]).select(
        "id",
        "position",
        F.col("artists.id").alias("artist"),
        F.col("available_markets").alias("market"),
    )


@query(
    "explode_drop_empty",
    f"""
    SELECT id, "position", {V.MARKET_SQL} AS market
    FROM ({V.TRACK_DOCS_SQL}), {V.DOC_MARKETS_SQL} WHERE {V.HAS_MARKET_SQL}
    """,
)
def explode_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.track_docs(spark, sf_dir)
    return explode_columns(docs, ["available_markets"]).select(
        "id", "position", F.col("available_markets").alias("market")
    )


@query(
    "flatten_struct",
    f"""
    SELECT album_type, album_href, album_id, album_name, album_release_date,
           album_total_tracks, album_uri, isrc, spotify, id
    FROM ({V.TRACK_DOCS_SQL})
    """,
)
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.track_docs(spark, sf_dir).select(
        *leaves("album.album_type"),
        *prefixed("album", ALBUM_FIELDS),
        *leaves("external_ids.isrc", "external_urls.spotify"),
        "id",
    )
