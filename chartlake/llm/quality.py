"""Quality by nearest-neighbour voting on latent-semantic vectors.

A text becomes a tf-idf vector of hashed character trigrams with a few shares of style
beside it (repeated words, symbols, capitals, digits), then a latent-semantic vector
through the singular vectors of a bounded labelled sample. The
sample's vectors and labels are broadcast; each block of documents takes its cosine
products with all of them, and the nearest vote with their similarity as weight.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.shared import chosen, small_batches

FEATURES = 4096
LATENT = 64
NEIGHBOURS = 15
# Labelled rows of each class that are learnt from, at most. The broadcast holds
# 2 * SAMPLE * LATENT floats and about FEATURES * LATENT floats: 1.6 MB.
SAMPLE = 1000
BLOCK = 512
# Turns of the search for the axes, and the error of a vector, as a share of the largest
# eigenvalue, at which it ends.
TURNS = 100
SETTLED = 1e-10
# How much a style share of 1 counts beside the tf-idf vector, whose length is 1.
STYLE_WEIGHT = 3
# Kind of a byte: symbol 1, capital 2, digit 3, else 0.
KINDS = np.array([
    2 if chr(c).isupper() else 3 if chr(c).isdigit() else 0 if chr(c).isalpha() or c <= 32 or c in b".,;:'-" else 1
    for c in range(128)
] + [0] * 128)


# What a scoring task needs, by name: idf, axes, vectors, labels, prior. Plain arrays, so
# that executors can read it without this package; its size is fixed by the constants.
Voters = dict


def counts_of(text: str | None) -> np.ndarray:
    """Hashed counts of the text's byte trigrams, white space as one kind of byte."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) < 3:
        data = np.concatenate((data, np.zeros(3 - len(data), np.uint8)))
    wide = data.astype(np.uint32)
    grams = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    cells = (grams * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
    return np.bincount(cells, minlength=FEATURES)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: logarithmic term frequency times inverse document frequency."""
    rows = np.log1p(counts).astype(np.float32) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def projected(rows: np.ndarray, axes: np.ndarray) -> np.ndarray:
    low = rows @ axes
    return low / np.maximum(np.linalg.norm(low, axis=1, keepdims=True), 1e-9)


def style_of(text: str | None) -> list[float]:
    """Shares of repeated words, symbols, capitals and digits, each from 0 to 1."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words, size = data.split(), max(1, len(data))
    kinds = KINDS[np.frombuffer(data, np.uint8)]
    found = np.bincount(kinds, minlength=4)
    return [
        sum(map(eq, words, words[1:])) / max(1, len(words)),
        sum(map(eq, words, words[2:])) / max(1, len(words)),
        found[1] / size, found[2] / size, found[3] / size,
    ]


def features(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    counts = np.stack([counts_of(t) for t in texts])
    style = np.array([style_of(t) for t in texts], np.float32) * STYLE_WEIGHT
    return np.concatenate((weighted(counts, idf), style), axis=1)


def document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the documents of a task: how many there are and how many have each feature."""
    n, found = 0, np.zeros(FEATURES, np.int64)
    for batch in batches:
        for text in batch.column(0):
            found += counts_of(text.as_py()) > 0
            n += 1
    yield pa.RecordBatch.from_pydict(
        {"feature": np.arange(-1, FEATURES), "n": np.concatenate(([n], found))}
    )


def sample_features(idf: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = features(batch.column("text").to_pylist(), idf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([zlib.compress(r.tobytes()) for r in found], pa.binary()), batch.column("label")],
                    names=["features", "label"],
                )

    return rows


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: CRC-32 of the id's text is 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def leading(gram: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a positive semidefinite matrix, and their vectors.

    Block iteration holds a few columns beside the matrix; a full decomposition would hold
    the matrix five times. Where the iteration does not settle, that is what is left.
    """
    n, width = len(gram), 4 * count
    if n > 2 * width:
        moved = np.random.default_rng(0).standard_normal((n, width))
        for _ in range(TURNS):
            block = np.linalg.qr(gram @ moved)[0]
            moved = gram @ block
            values, turned = np.linalg.eigh(block.T @ moved)
            values, turned = values[::-1][:count], turned[:, ::-1][:, :count]
            vectors = block @ turned
            off = np.linalg.norm(moved @ turned - vectors * values, axis=0)
            if off.max() <= SETTLED * values[0]:
                return values, vectors
    values, vectors = np.linalg.eigh(gram)
    return values[::-1][:count], vectors[:, ::-1][:, :count]


def singular_axes(matrix: np.ndarray, latent: int) -> np.ndarray:
    """The first right singular vectors, through the smaller Gram matrix of the sample."""
    gram = np.empty((len(matrix), len(matrix)))
    for first in range(0, len(matrix), BLOCK):
        own = matrix[first : first + BLOCK]
        end = first + len(own)
        gram[first:end, first:end] = own @ own.T
        gram[first:end, :first] = own @ matrix[:first].T
        gram[:first, first:end] = gram[first:end, :first].T
    values, left = leading(gram, latent)
    keep = values > 1e-9
    return (matrix.T @ (left[:, keep] / np.sqrt(values[keep])).astype(np.float32)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, latent: int = LATENT) -> Voters:
    """Voters from ``docs`` (doc_id, text) and ``labels`` (doc_id, label).

    Document frequencies are counted over all documents. The labelled rows are those of
    each class with the smallest hashes of their id, at most ``sample`` a class; rows with
    conflicting labels for one id, with null labels or of the held-out fold do not count.
    Where an id stands on several texts, the one with the smallest hash is learnt from.
    """
    spark = small_batches(docs).sparkSession
    counted = (
        docs.select("text").mapInArrow(document_frequencies, "feature long, n long")
        .groupBy("feature").agg(F.sum("n").alias("n")).collect()
    )
    frequency = np.zeros(FEATURES + 1)
    for row in counted:
        frequency[row["feature"] + 1] = row["n"]
    idf = (np.log((1 + frequency[0]) / (1 + frequency[1:])) + 1).astype(np.float32)

    usable = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("turn"))
    )
    drawn = None
    for label in (0, 1):
        own = usable.filter(F.col("label") == label).orderBy("turn", "doc_id").limit(sample)
        drawn = own if drawn is None else drawn.unionByName(own)
    drawn = spark.createDataFrame(drawn.select("doc_id", "label").collect(), "doc_id long, label int")
    # Of texts with the same id the one with the smallest hash, whatever the order of the rows.
    rows = (
        docs.join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))
        .select("text", "label").mapInArrow(sample_features(idf), "features binary, label int").collect()
    )
    class_sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    prior = class_sizes.get(1, 0) / max(1, sum(class_sizes.values())) if class_sizes else 0.5
    if not rows:
        return Voters(
            idf=idf, axes=np.zeros((FEATURES + len(style_of(None)), 1), np.float32), vectors=np.zeros((0, 1), np.float32),
            labels=np.zeros(0, np.float32), prior=prior,
        )
    rows.sort(key=lambda r: (r["label"], bytes(r["features"])))
    # Rows are mostly zeros and come compressed; each is unpacked straight into its place.
    matrix = np.empty((len(rows), FEATURES + len(style_of(None))), np.float32)
    for i, r in enumerate(rows):
        matrix[i] = np.frombuffer(zlib.decompress(r["features"]), np.float32)
    labels_of = np.array([r["label"] for r in rows], np.float32)
    rows.clear()
    axes = singular_axes(matrix, latent)
    return Voters(idf=idf, axes=axes, vectors=projected(matrix, axes), labels=labels_of, prior=prior)


def vote(similar: np.ndarray, voters: Voters, neighbours: int) -> np.ndarray:
    """Scores from cosine products, a row per document: the weight of label 1 among all.

    Both classes are sampled alike, so a vote counts by how frequent its class is.
    """
    n = similar.shape[1]
    if n == 0:
        return np.full(len(similar), voters["prior"])
    k = min(neighbours, n)
    nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(similar, nearest, axis=1), 0) ** 4 + 1e-6
    return (weight * voters["labels"][nearest]).sum(axis=1) / weight.sum(axis=1)


def scorer(voters, neighbours: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = voters.value
        for batch in batches:
            texts, out = batch.column("_text"), []
            for first in range(0, len(texts), BLOCK):
                own = features(texts[first : first + BLOCK].to_pylist(), known["idf"])
                low = projected(own, known["axes"])
                out.append(vote(low @ known["vectors"].T, known, neighbours))
            scores = np.concatenate(out) if out else np.zeros(0)
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(scores.astype(np.float64))], names=[*batch.schema.names[1:], "_score"]
            )

    return score


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null, empty and very short texts are padded to one trigram and scored like all others.
    Null ids are not held out and never learnt from. Repeated rows get equal scores.
    Without any usable label every score is 0.5; with labels of one class that class wins.
    An empty table gives no rows. Other columns are ignored.
    """
    texts = chosen(docs, doc_id=id_col, text=text_col)
    voters = fit(texts, chosen(labels, doc_id=id_col, label=label_col), sample)
    known = docs.sparkSession.sparkContext.broadcast(voters)
    return (
        texts.select(F.col("text").alias("_text"), "doc_id")
        .mapInArrow(scorer(known, neighbours), "doc_id long, _score double")
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            F.col("_score").alias("score"),
            (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        )
    )


def reject_poor(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample: int = SAMPLE, neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """The rows of ``docs``, with their columns, that score 0.5 or more; see :func:`classify`."""
    voters = fit(
        chosen(docs, doc_id=id_col, text=text_col), chosen(labels, doc_id=id_col, label=label_col), sample
    )
    known = docs.sparkSession.sparkContext.broadcast(voters)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = F.col(f"c{docs.columns.index(text_col)}").alias("_text")
    schema = T.StructType([*plain.schema.fields, T.StructField("_score", T.DoubleType())])
    scored = plain.select(text, *plain.columns).mapInArrow(scorer(known, neighbours), schema)
    return scored.filter("_score >= 0.5").drop("_score").toDF(*docs.columns)
