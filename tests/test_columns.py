from __future__ import annotations

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartlake.functions import columns as C
from chartlake.operators.generators import explode_columns, rank_entries
from chartlake.operators.projections import leaves, prefixed
from chartlake.plans.extras import order_totals
from chartlake.plans.landing import record_key, tracks_key


def values(spark, kind, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_parse_day(spark):
    texts = ["2022-04-01", "2022-13-40", "", "April", None]
    assert values(spark, "STRING", texts, C.parse_day) == [date(2022, 4, 1)] + [None] * 4


def test_day_and_timestamp_text(spark):
    assert values(spark, "STRING", ["2022-04-01T23:59:59Z"], C.day_text) == ["2022-04-01"]
    moment = datetime(2022, 4, 1, 3, 4, 5, 999999)
    assert values(spark, "TIMESTAMP_NTZ", [moment], C.timestamp_text) == ["2022-04-01 03:04:05"]


def test_url_last_segment(spark):
    urls = ["https://x/playlist/abc?si=1&t=/z", "https://x/track/abc", "abc", "https://x/"]
    # The query text of the first one holds a slash, so what follows it counts.
    assert values(spark, "STRING", urls, C.url_last_segment) == ["z", "abc", "abc", ""]


def test_keys(spark):
    assert values(
        spark, "INT", [7], lambda v: tracks_key(F.lit("2022-04-01").cast("date"), v)
    ) == ["tracks/musica2022-04-017.json"]
    assert values(spark, "STRING", ["x"], lambda v: record_key("artists", v)) == ["artists/x.json"]


def test_joined_skips_nulls(spark):
    lists = [["a", None, "b"], [], [None]]
    assert values(spark, "ARRAY<STRING>", lists, C.joined) == ["a, b", "", ""]


def test_order_total(spark):
    texts = ['{"7": 12.5, "8": 30.25, "9": 1.1}', "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = [r[0] for r in order_totals(df, "text").select("total_text").collect()]
    assert got == ["43.85", "0.00"]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.one_of(
            st.floats(-1e9, 1e9),
            st.integers(-10**6, 10**6).map(lambda n: n / 200),  # decimal ties
            st.integers(-10**6, 10**6).map(lambda n: n / 8),  # exact binary ties
        ),
        min_size=1,
        max_size=50,
    )
)
def test_two_decimals_round_like_python(spark, numbers):
    assert values(spark, "DOUBLE", numbers, C.two_decimals) == [f"{n:.2f}" for n in numbers]


def test_json_text_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    assert df.select(C.to_json_text("a", "b")).first()[0] == '{"a":1,"b":null}'


def test_pluck_and_rank(spark):
    df = spark.createDataFrame(
        [("s", [("x", "1"), ("y", "2")]), ("empty", []), ("none", None)],
        "name STRING, tracks ARRAY<STRUCT<url: STRING, added_at: STRING>>",
    )
    assert df.select(C.pluck(F.col("tracks"), "url")).first()[0] == ["x", "y"]
    ranked = rank_entries(df, "tracks", "entry").select("name", "entry.url", "position")
    assert [tuple(r) for r in ranked.collect()] == [("s", "x", 1), ("s", "y", 2)]


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=4)),
            st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=4)),
        ),
        min_size=1,
        max_size=8,
    )
)
def test_two_explodes_give_the_product(spark, pairs):
    df = spark.createDataFrame(pairs, "a ARRAY<INT>, b ARRAY<INT>")
    inner = sorted(tuple(r) for r in explode_columns(df, ["a", "b"]).collect())
    assert inner == sorted((x, y) for a, b in pairs for x in a or () for y in b or ())
    outer = explode_columns(df, ["a", "b"], outer=True).count()
    assert outer == sum(max(len(a or ()), 1) * max(len(b or ()), 1) for a, b in pairs)


def test_struct_names(spark):
    df = spark.createDataFrame([((("v",), "n"),)], "s STRUCT<inner: STRUCT<leaf: STRING>, name: STRING>")
    assert df.select(*leaves("s.inner.leaf", "s.name")).columns == ["leaf", "name"]
    assert df.select(*prefixed("s", ["name"])).columns == ["s_name"]
