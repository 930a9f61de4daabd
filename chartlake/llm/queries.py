"""The named queries of this package, each next to its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.llm.exact_dedup import exact_dedup
from chartlake.llm.decontamination import decontaminate
from chartlake.llm.html import extract
from chartlake.llm.lexical import lexical_search
from chartlake.llm.licenses import document_licenses
from chartlake.llm.lines import drop_repeated_lines
from chartlake.llm.lm import lm_scores
from chartlake.llm.ngram_join import ngram_join
from chartlake.llm.mixing import (
    BLOCK_WORDS,
    CELL_ROWS,
    LEAST_BLOCKS,
    MOST_SLOTS,
    PRIMES,
    SHARD_BLOCKS,
    mixed_sizes,
)
from chartlake.llm.negatives import hard_negatives
from chartlake.llm.quality import classify
from chartlake.llm.repeats import repeated_passages
from chartlake.llm.shared import read_table
from chartlake.llm.sharding import shard_documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"), shards=16)


# The same permutation in DuckDB; x, n and seed are SQL expressions.
def _permuted_sql(x: str, n: str, seed: str) -> str:
    primes = ", ".join(map(str, PRIMES))
    for turn in (1, 2):
        x = (
            f"(([{primes}][(({seed}) + {turn}) % {len(PRIMES)} + 1]::BIGINT * ({x})"
            f" + ({seed}) * 7919 + {turn}) % ({n}))"
        )
        bits = f"floor(log2({n} + 0.5))::BIGINT"
        half = f"greatest(1, ({bits} + 1) // 2)"
        x = f"(SELECT CASE WHEN v < (1::BIGINT << {bits}) THEN xor(v, v >> {half}) ELSE v END FROM (SELECT {x} AS v))"
    return x


OP2_SQL = f"""
    WITH t AS (
        SELECT row_number() OVER () AS row_no, doc_id, source,
               coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
        FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size, count(*) AS source_rows,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
        FROM t GROUP BY source
    ), w AS (
        SELECT *, [3, 1, 2][source_no % 3 + 1] AS weight, 2 * source_size AS f,
               f::DOUBLE / weight AS ratio
        FROM s
    ), l AS (
        SELECT *,
               (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(f) OVER before, 0)::DOUBLE)
               / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
        FROM w
        WINDOW before AS (ORDER BY ratio, source_no
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), g AS (
        SELECT source, source_no, source_size, source_rows,
               least(f::DOUBLE, coalesce((SELECT arg_min(level, ratio * 1000003 + source_no)
                                          FROM l WHERE ratio >= level) * weight, f::DOUBLE)) AS target,
               greatest(1, least(greatest({BLOCK_WORDS}, ceil(sum(source_size) OVER () * 1.5 / {MOST_SLOTS})),
                                 source_size // {LEAST_BLOCKS}))::BIGINT AS length,
               (source_size + length - 1) // length AS blocks
        FROM l
    ), h AS (
        SELECT *, coalesce(sum(quota) OVER (ORDER BY source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
                  AS first, (sum(quota) OVER ())::BIGINT AS total
        FROM (SELECT *, CASE WHEN source_size > 0 THEN round(target / source_size * blocks)::BIGINT ELSE 0 END AS quota FROM g)
    ), dealt AS (
        SELECT source_no, blocks, {_permuted_sql("first + k", "total", "3")} // {SHARD_BLOCKS} AS shard
        FROM (SELECT source_no, blocks, first, total, unnest(range(quota)) AS k FROM h)
    ), slots AS (
        SELECT source_no, blocks, shard, row_number() OVER (PARTITION BY source_no ORDER BY shard) - 1 AS slot FROM dealt
    ), taken AS (
        SELECT source_no, block, shard, count(*) AS times FROM (
            SELECT source_no, shard, {_permuted_sql("slot % blocks", "blocks", "source_no * 31 + slot // blocks * 17")} AS block
            FROM slots) GROUP BY ALL
    ), d AS (
        SELECT row_no, doc_id, size, source_size, target, source_no, length,
               sum(size) OVER (PARTITION BY source_no
                   ORDER BY coalesce(doc_id, size) % ((source_rows + {CELL_ROWS - 1}) // {CELL_ROWS}),
                            doc_id NULLS FIRST, size, row_no) - size AS start
        FROM t JOIN h ON t.source IS NOT DISTINCT FROM h.source
    ), p AS (
        SELECT row_no, source_no, start, size, length,
               unnest(range((start // length)::BIGINT, ((start + size - 1) // length + 1)::BIGINT)) AS block
        FROM d WHERE size > 0
    ), o AS (
        SELECT row_no, shard, sum(times * (least(start + size, (block + 1) * length)
                                           - greatest(start, block * length)))::BIGINT AS words
        FROM p JOIN taken USING (source_no, block) GROUP BY row_no, shard
    ), w2 AS (
        SELECT row_no, sum(words)::BIGINT AS taken, string_agg(shard || ':' || words, ',' ORDER BY shard) AS shard_words
        FROM o GROUP BY row_no
    )
    SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken,
           coalesce(shard_words, '') AS shard_words
    FROM d LEFT JOIN w2 USING (row_no)
    """


@query("op2_mixing", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.transform("shards", lambda x: F.concat(x["shard"].cast("string"), F.lit(":"), x["words"].cast("string")))
    return mixed_sizes(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.array_join(words, ",").alias("shard_words")
    )


LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_licenses(read_table(spark, sf_dir, "documents"))


OP5_SQL = """
    WITH t AS (
        SELECT row_number() OVER () AS row_no, doc_id,
               coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS words
        FROM documents
    ), win AS (
        SELECT row_no, unnest(range(len(words) - 49)) AS s,
               unnest(list_transform(range(len(words) - 49),
                   lambda i: md5(array_to_string(words[i+1:i+50], ' ')))) AS h
        FROM t WHERE len(words) >= 50
    ), rep AS (
        SELECT h FROM win GROUP BY h HAVING count(DISTINCT row_no) > 1
    ), hit AS (
        SELECT row_no, s, s - coalesce(lag(s) OVER (PARTITION BY row_no ORDER BY s), -1000) > 50 AS new
        FROM win SEMI JOIN rep USING (h)
    ), part AS (
        SELECT row_no, s, sum(new::INT) OVER (PARTITION BY row_no ORDER BY s) AS p FROM hit
    )
    SELECT any_value(doc_id) AS doc_id, min(s)::BIGINT AS first_word,
           (max(s) + 50 - min(s))::BIGINT AS n_words
    FROM part JOIN t USING (row_no) GROUP BY row_no, p
    """


@query("op5_suffix_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"))


OP6_SQL = """
    WITH t AS (
        SELECT row_number() OVER () AS row_no, doc_id,
               coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS words
        FROM documents
    ), w AS (
        SELECT row_no, unnest(range(len(words))) AS i, unnest(words) AS w FROM t
    ), g AS (
        SELECT row_no, w, lag(w) OVER (PARTITION BY row_no ORDER BY i) AS v FROM w
    ), uni AS (SELECT w, count(*) AS n FROM w GROUP BY w),
    own_uni AS (SELECT row_no, w, count(*) AS n FROM w GROUP BY ALL),
    bi AS (SELECT v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY ALL),
    own_bi AS (SELECT row_no, v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY ALL),
    s AS (
        SELECT g.row_no, g.v, uni.n - own_uni.n AS cw, bi.n - own_bi.n AS cvw, hu.n - ho.n AS cv,
               greatest((SELECT sum(n) FROM uni) - len(t.words), 1) AS rest
        FROM g JOIN uni ON uni.w = g.w JOIN own_uni ON own_uni.row_no = g.row_no AND own_uni.w = g.w
        JOIN t ON t.row_no = g.row_no
        LEFT JOIN bi ON bi.v = g.v AND bi.w = g.w
        LEFT JOIN own_bi ON own_bi.row_no = g.row_no AND own_bi.v = g.v AND own_bi.w = g.w
        LEFT JOIN uni hu ON hu.w = g.v
        LEFT JOIN own_uni ho ON ho.row_no = g.row_no AND ho.w = g.v
    ), p AS (
        SELECT row_no, sum(ln(CASE WHEN cvw > 0 THEN cvw / cv
            ELSE CASE WHEN v IS NULL THEN 1 ELSE 0.4::DOUBLE END * greatest(cw, 0.5::DOUBLE) / rest END)) AS total
        FROM s GROUP BY row_no
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, round(coalesce(total, 0::DOUBLE), 5) AS log_score
    FROM t LEFT JOIN p USING (row_no)
    """


@query("op6_lm_scoring", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.round("log_score", 5).alias("log_score")
    )


# With order 3: word w after u and v.
LM_ORDER3_SQL = """
    WITH t AS (
        SELECT row_number() OVER () AS row_no, doc_id,
               coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS words
        FROM documents
    ), a AS (
        SELECT row_no, unnest(range(len(words))) AS i, unnest(words) AS w FROM t
    ), g AS (
        SELECT row_no, w, lag(w) OVER place AS v, lag(w, 2) OVER place AS u
        FROM a WINDOW place AS (PARTITION BY row_no ORDER BY i)
    ), own_uni AS (SELECT row_no, w, count(*) AS n FROM g GROUP BY ALL),
    own_bi AS (SELECT row_no, v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY ALL),
    own_tri AS (SELECT row_no, u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY ALL),
    uni AS (SELECT row_no, w, sum(n) OVER (PARTITION BY w) - n AS n FROM own_uni),
    bi AS (SELECT row_no, v, w, sum(n) OVER (PARTITION BY v, w) - n AS n FROM own_bi),
    tri AS (SELECT row_no, u, v, w, sum(n) OVER (PARTITION BY u, v, w) - n AS n FROM own_tri),
    s AS (
        SELECT g.row_no, g.u, g.v, x.n AS cw, y.n AS cvw, z.n AS cuvw, hx.n AS cv, hy.n AS cuv,
               greatest((SELECT sum(n) FROM own_uni) - len(t.words), 1) AS rest
        FROM g JOIN t ON t.row_no = g.row_no JOIN uni x ON x.row_no = g.row_no AND x.w = g.w
        LEFT JOIN bi y ON y.row_no = g.row_no AND y.v = g.v AND y.w = g.w
        LEFT JOIN tri z ON z.row_no = g.row_no AND z.u = g.u AND z.v = g.v AND z.w = g.w
        LEFT JOIN uni hx ON hx.row_no = g.row_no AND hx.w = g.v
        LEFT JOIN bi hy ON hy.row_no = g.row_no AND hy.v = g.u AND hy.w = g.v
    ), one AS (SELECT *, greatest(cw, 0.5::DOUBLE)::DOUBLE / rest::DOUBLE AS p1 FROM s),
    two AS (
        SELECT *, CASE WHEN v IS NULL THEN p1 WHEN cvw > 0 THEN cvw::DOUBLE / cv::DOUBLE ELSE 0.4::DOUBLE * p1 END AS p2
        FROM one
    ), p AS (
        SELECT row_no, sum(ln(CASE WHEN u IS NULL THEN p2 WHEN cuvw > 0 THEN cuvw::DOUBLE / cuv::DOUBLE
                              ELSE 0.4::DOUBLE * p2 END)) AS total
        FROM two GROUP BY row_no
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, round(coalesce(total, 0::DOUBLE), 5) AS log_score
    FROM t LEFT JOIN p USING (row_no)
    """


def lm_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"), order=3).select(
        "doc_id", "n_words", F.round("log_score", 5).alias("log_score")
    )


# Registered besides the ten; the SQL of op6 is of order 2.
MORE_QUERIES: dict[str, Query] = {"lm_scoring_order3": lm_order3}
MORE_ORACLES: dict[str, str] = {"lm_scoring_order3": LM_ORDER3_SQL}


OP7_SQL = f"""
    WITH t AS (
        SELECT row_number() OVER () AS row_no, doc_id,
               coalesce(regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words
        FROM documents
    ), b AS (
        SELECT item_id, coalesce(regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words
        FROM benchmark
    ), win AS (
        SELECT DISTINCT item_id, least(len(words), 10) AS n, unnest(list_transform(
            range(greatest(len(words) - 9, 1)), lambda i: array_to_string(words[i+1:i+10], ' '))) AS w
        FROM b WHERE len(words) > 0
    ), grams AS (
        SELECT row_no, n, unnest(range(len(words) - n + 1)) AS start,
               unnest(list_transform(range(len(words) - n + 1),
                   lambda i: array_to_string(words[i+1:i+n], ' '))) AS w
        FROM t, (SELECT DISTINCT n FROM win) WHERE len(words) >= n
    ), hit AS (
        SELECT row_no, start, grams.n, item_id FROM grams JOIN win USING (w, n)
    ), words_hit AS (
        SELECT row_no, count(DISTINCT slot) AS n_hit
        FROM (SELECT row_no, unnest(range(start, start + n)) AS slot FROM hit) GROUP BY row_no
    ), items AS (
        SELECT row_no, count(*) AS n_items,
               sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
        FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS item_id FROM hit) GROUP BY row_no
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM t LEFT JOIN words_hit USING (row_no) LEFT JOIN items USING (row_no)
    """


@query("op7_decontamination", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10
    ).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


OP8_SQL = f"""
    WITH RECURSIVE t AS (
        SELECT row_number() OVER () AS row_no, doc_id,
               coalesce(regexp_extract_all({LOWER_SQL}, '[^\\x20\\x09-\\x0D]+'), []) AS words
        FROM documents
    ), sh AS (
        SELECT DISTINCT row_no, unnest(
            CASE WHEN len(words) >= 4
                 THEN list_transform(range(len(words) - 3), lambda i: array_to_string(words[i+1:i+4], ' '))
                 WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
                 ELSE [] END) AS s
        FROM t
    ), n AS (
        SELECT row_no, count(*) AS n FROM sh GROUP BY row_no
    ), pairs AS (
        SELECT a.row_no AS a, b.row_no AS b, count(*) AS inter
        FROM sh a JOIN sh b ON a.s = b.s AND a.row_no < b.row_no GROUP BY ALL
    ), link AS (
        SELECT a, b FROM pairs JOIN n x ON x.row_no = a JOIN n y ON y.row_no = b
        WHERE 100 * inter >= 85 * (x.n + y.n - inter)
    ), both_ways AS (
        SELECT a, b FROM link UNION SELECT b, a FROM link UNION SELECT row_no, row_no FROM t
    ), reach AS (
        SELECT a, b FROM both_ways
        UNION
        SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
    ), least AS (
        SELECT a AS row_no, min(doc_id) AS component_id
        FROM reach JOIN t ON t.row_no = reach.b GROUP BY a
    )
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
    FROM t LEFT JOIN n USING (row_no) JOIN least USING (row_no)
    """


@query("op8_ngram_join", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents"), words=4, percent=85)


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query(
    "op10_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
        FROM documents
    ), w AS (
        SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
               first_value(doc_id) OVER (
                   PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
               row_number() OVER (
                   PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) = 1 AS kept
        FROM t
    )
    SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM w
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


KEY_SQL = r"""
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
"""
OP11_SQL = f"""
    WITH t AS (
        SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents
    ), l AS (
        SELECT row_no, doc_id, unnest(range(len(lines))) AS place, unnest(lines) AS line FROM t
    ), k AS (
        SELECT *, {KEY_SQL} AS key FROM l
    ), common AS (
        SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key
        HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 2
    ), m AS (
        SELECT row_no, place, line, common.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
        FROM k LEFT JOIN common USING (key)
    ), g AS (
        SELECT row_no, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept
        FROM m GROUP BY row_no
    )
    SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM t JOIN g USING (row_no)
    """


@query("op11_line_dedup", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


TERMS_SQL = r"coalesce(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])"
OP12_SQL = f"""
    WITH d AS (
        SELECT row_number() OVER () AS row_no, doc_id, {TERMS_SQL} AS words FROM documents
    ), p AS (
        SELECT row_no, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term,
               count(*) AS tf
        FROM (SELECT row_no, unnest(words) AS w FROM d) GROUP BY ALL
    ), a AS (
        SELECT count(*)::BIGINT AS n_all, sum(len(words))::BIGINT AS terms_all FROM d WHERE len(words) > 0
    ), df AS (
        SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
        FROM p, a GROUP BY term, n_all
    ), q AS (
        SELECT DISTINCT item_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM (SELECT item_id, unnest({TERMS_SQL}) AS w FROM benchmark)
    ), s AS (
        SELECT item_id, row_no, sum(weight * ((1000000000 * tf)
                   // (1000 * tf + 20 * (100 - 50 + (50 * len(words)::BIGINT * n_all) // terms_all))))::BIGINT AS score
        FROM q JOIN df USING (term) JOIN p USING (term) JOIN d USING (row_no), a
        GROUP BY item_id, row_no
    ), r AS (
        SELECT item_id, doc_id, score, row_number() OVER (
                   PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
        FROM s JOIN d USING (row_no) WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
    """


@query("op12_lexical_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50
    )


OP13_SQL = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
               list_inner_product(a.q, c.q)::BIGINT AS score
        FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
    ), p AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id, row_number() OVER w ::INTEGER AS rank, id AS negative_id,
           positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
    QUALIFY rank <= 3
    """


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings").withColumn("label", label))
