"""Licence scan: notices in texts, licence files, and inheritance by directory (native).

Windows of consecutive words, anywhere in a text and across its lines, are compared with
templates of headers and licence texts by the cosine of sparse tf-idf vectors. A licence file
speaks for its directory; a file without a notice of its own inherits from the nearest
directory above it that has a licence file.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.llm.notices import TOKEN, Template, templates
from chartlake.llm.shared import chosen, staged

THRESHOLD = 0.7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({TOKEN})"), F.lit(1))


def unit_vector(template: Template, idf: dict[str, float]) -> dict[str, float]:
    raw = {t: n * idf[t] for t, n in Counter(template.words).items()}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / norm for t, w in raw.items()}


def anchor(template: Template, frequency: dict[str, int]) -> tuple[str, list[int]]:
    """The rarest of the words that a window must have, and where the template has it."""
    word = min(template.named, key=lambda t: (frequency.get(t, 0), t))
    return word, [i for i, t in enumerate(template.words) if t == word]


def windows(texts: DataFrame, known: list[Template], frequency: dict[str, int]) -> DataFrame:
    """(_row, start, template, closing, words): the windows that can be notices.

    ``texts`` has (_row, words). For each template a window of its length is laid wherever
    the text has the template's anchor, so that the anchor stands where the template has it,
    as far as the text goes. Windows without all the words that name the licence are left
    out. ``closing``: the window reaches the end of the text.
    """
    # A table of a few hundred rows that the templates fix.
    laid = texts.sparkSession.createDataFrame(
        [
            (word, i, place, len(template.words), template.named)
            for i, template in enumerate(known)
            for word, places in [anchor(template, frequency)]
            for place in places
        ],
        "anchor string, template int, place int, length int, named array<string>",
    )
    met = texts.select("_row", F.posexplode("words").alias("at", "anchor")).join(F.broadcast(laid), "anchor")
    return (
        met.join(texts, "_row")
        .withColumn("start", F.greatest(F.lit(0), F.col("at") - F.col("place")))
        .withColumn("end", F.least(F.size("words"), F.col("at") - F.col("place") + F.col("length")))
        .select(
            "_row", "start", "template", (F.col("end") == F.size("words")).alias("closing"), "named",
            F.slice("words", F.col("start") + 1, F.col("end") - F.col("start")).alias("words"),
        )
        .filter(F.size(F.array_except("named", "words")) == 0)
        .drop("named")
    )


def scan(files: DataFrame, path_col: str, text_col: str, speaks: Column, threshold: float = THRESHOLD) -> DataFrame:
    """One row per file: its columns, then licence, how, score, from_dir.

    ``files`` has a path (directories separated by ``/``), a text, and what else is to be
    kept. ``speaks`` decides whether a notice makes its file a licence file; it may use
    ``_path`` and ``closing``, whether the notice ends with the last word of the text.
    ``how``: ``notice``, ``inherited`` or null. Of several notices the one counts whose score
    to one decimal is highest, then the one of the longest template, since a text can hold
    the shorter text of another licence, then the highest score, then the licence first by
    name; of several licence files in a directory too.

    Frequencies are counted over all files; a word of no template has the weight of an
    unseen one. Null and empty texts have no notice and can inherit. A null path is an
    unnamed file outside all directories. Repeated rows stay. An empty table gives no
    rows.
    """
    spark = files.sparkSession
    known = templates()
    names = sorted({t for template in known for t in template.words})
    kept = [c for c in files.columns if c not in (path_col, text_col)]
    plain = files.select(
        F.col(path_col).alias("_path"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)]
    )
    # One row per template word at most.
    found = F.array_intersect(tokens(F.coalesce("_text", F.lit(""))), F.array(*map(F.lit, names)))
    counted = plain.select(F.explode(found).alias("t")).groupBy("t").count().collect()
    total = plain.count()
    frequency = {r["t"]: r["count"] for r in counted}
    idf = {t: math.log((1 + total) / (1 + frequency.get(t, 0))) + 1 for t in names}
    unseen = math.log(1 + total) + 1

    # Only texts with an anchor go on with their words.
    anchors = sorted({anchor(template, frequency)[0] for template in known})
    words = tokens(F.col("_text"))
    entries = staged(
        plain.withColumn("words", words).withColumns({
            "words": F.when(F.arrays_overlap("words", F.array(*map(F.lit, anchors))), F.col("words")),
            "_dir": F.when(F.instr("_path", "/") > 0, F.regexp_replace("_path", "/[^/]*$", "")),
            "_row": F.monotonically_increasing_id(),
        }).drop("_text"),
        "files",
    )
    spans = staged(
        windows(entries.filter("words is not null").select("_row", "words"), known, frequency).distinct(), "windows"
    )
    # A table of a few thousand rows that the templates fix.
    weights = spark.createDataFrame(
        [
            (t, i, template.licence, len(template.words), w)
            for i, template in enumerate(known) for t, w in sorted(unit_vector(template, idf).items())
        ],
        "term string, template int, licence string, length int, share double",
    )
    idfs = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    window = ["_row", "start", "template", "closing"]
    terms = (
        spans.select(*window, F.explode("words").alias("term"))
        .groupBy(*window, "term").agg(F.count("*").alias("tf"))
        .join(F.broadcast(idfs), "term", "left")
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
        .join(F.broadcast(weights), ["term", "template"], "left")
    )
    cosines = (
        terms.groupBy(*window)
        .agg(
            F.max("licence").alias("licence"), F.max("length").alias("length"), F.sum(F.col("w") * F.coalesce("share", F.lit(0.0))).alias("dot"),
            F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        )
        .withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
        .filter(F.col("score") >= threshold)
    )
    rank = F.struct(
        (-F.round("score", 1)).alias("about"), (-F.col("length")).alias("shorter"), (-F.col("score")).alias("less"), "licence"
    )
    places = entries.select("_row", "_path", "_dir")
    best_windows = (
        cosines.groupBy("_row", "closing").agg(F.min(rank).alias("best")).join(places, "_row").withColumn("speaks", speaks)
    )
    noticed = best_windows.groupBy("_row").agg(F.min("best").alias("own"))
    speaking = (
        best_windows.filter("speaks and _dir is not null").groupBy("_dir").agg(F.min("best").alias("given"))
    )

    # Each directory finds its nearest licensed ancestor, itself first.
    parts = F.split("_dir", "/")
    dirs = entries.filter("_dir is not null").select("_dir").distinct().withColumn(
        "depth", F.explode(F.sequence(F.lit(1), F.size(parts)))
    )
    above = (
        dirs.withColumn("from_dir", F.concat_ws("/", F.slice(parts, F.lit(1), F.col("depth"))))
        .join(speaking.withColumnRenamed("_dir", "from_dir"), "from_dir")
        .groupBy("_dir")
        .agg(F.max(F.struct("depth", "from_dir", "given")).alias("near"))
    )
    own, near = F.col("own"), F.col("near")
    return (
        entries.drop("words")
        .join(noticed, "_row", "left")
        .join(above, "_dir", "left")
        .select(
            F.col("_path").alias(path_col),
            *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)],
            F.coalesce(own["licence"], near["given"]["licence"]).alias("licence"),
            F.when(own.isNotNull(), "notice").when(near.isNotNull(), "inherited").alias("how"),
            F.when(own.isNotNull(), -own["less"]).otherwise(-near["given"]["less"]).alias("score"),
            F.when(own.isNull(), near["from_dir"]).alias("from_dir"),
        )
    )


def document_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang"
) -> DataFrame:
    """Licences of documents: doc_id, path, licence, how, score, from_dir.

    A document stands at ``source/lang/doc_id``. One that closes with a notice is a
    licence file of its directory. Documents without a source stand outside all
    directories; a missing language is left out of the path. See :func:`scan`.
    """
    rows = chosen(docs, doc_id=id_col, text=text_col, source=source_col, lang=lang_col)
    placed = rows.select(
        "doc_id", "text",
        F.when(F.col("source").isNotNull(), F.concat_ws("/", "source", "lang", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))).alias("path"),
    )
    return scan(placed, "path", "text", F.col("closing"))
