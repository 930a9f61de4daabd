"""Counts of hashed keys over all documents, brought back to where the keys stand.

Every segment of documents sends each of its distinct keys once, with its own count, to
hash buckets, packed in arrays. A bucket adds up the counts and returns them in the order
in which they came. The segment, read a second time, knows its keys in that same order.
A key that stands in every document is one entry per segment, so no bucket meets an
unbounded group, and nothing about single documents passes through a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.llm.packing import pack_numbers, pack_sorted, segments, unpack_numbers, unpack_sorted
from chartlake.llm.shared import small_batches

# Length of text for which a bucket is planned, and the fewest bits of a bucket number.
BUCKET_CHARS = 4_000_000
LEAST_BITS = 6

SENT = "segment long, key long, data binary, counts binary"
SENT_SCHEMA = pa.schema(
    [("segment", pa.int64()), ("key", pa.int64()), ("data", pa.binary()), ("counts", pa.binary())]
)

# A digest takes the word lists of a segment and gives, for each kind of key, the sorted
# distinct hashes and their counts in the segment. Kinds below 1 are not sent; a digest may
# keep there what ``use`` needs again.
Digest = Callable[[list], dict]


def text_chars(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.length("text"))).first()[0] or 0


def bucket_bits(chars: int) -> int:
    return max(LEAST_BITS, ceil(log2(max(1, chars / BUCKET_CHARS))))


def by_bucket(hashes: np.ndarray, bits: int, key_bits: int = 64) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of the runs of sorted hashes of ``key_bits`` that share a bucket."""
    buckets = (hashes >> np.uint64(key_bits - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(buckets, prepend=-1))
    ends = np.append(first[1:], len(hashes))
    return list(zip(buckets[first].tolist(), first.tolist(), ends.tolist()))


def sent_kinds(found: dict) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    return {kind: x for kind, x in found.items() if kind > 0}


def sender(split, digest: Digest, bits: int, key_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, words in segments(batches, split):
            rows = [
                (number, kind << 40 | bucket, pack_sorted(hashes[a:b]), pack_numbers(counts[a:b]))
                for kind, (hashes, counts) in sent_kinds(digest(words)).items()
                for bucket, a, b in by_bucket(hashes, bits, key_bits)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*rows), SENT_SCHEMA)], schema=SENT_SCHEMA
                )

    return send


def add_up(table: pa.Table) -> pa.Table:
    """Of one bucket: the same rows with counts over all segments and without the keys."""
    data = [unpack_sorted(x) for x in table.column("data").to_pylist()]
    counts = np.concatenate([unpack_numbers(x) for x in table.column("counts").to_pylist()])
    hashes = np.concatenate(data)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sums = np.add.reduceat(counts[order], first)
    total = np.empty(len(hashes), np.uint64)
    total[order] = np.repeat(sums, np.diff(np.append(first, len(ordered))))
    ends = np.cumsum([len(x) for x in data])
    packed = [pack_numbers(total[end - len(x) : end]) for x, end in zip(data, ends)]
    return pa.Table.from_arrays(
        [table.column("segment"), table.column("key"), pa.nulls(len(data), pa.binary()), pa.array(packed, pa.binary())],
        schema=SENT_SCHEMA,
    )


# Texts in pieces of this many travel compressed together, in fewer bytes than Spark's own
# fast compression of a shuffle leaves.
PIECE_DOCS = 1000
PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def pack_documents(ids: list, texts: list) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, PIECE_SCHEMA, options=options) as writer:
        writer.write_batch(
            pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], schema=PIECE_SCHEMA)
        )
    return sink.getvalue().to_pybytes()


def unpack_documents(pieces: list[bytes]) -> tuple[list, list]:
    """(ids, texts) of the pieces, in their order."""
    ids, texts = [], []
    for piece in pieces:
        found = pa.ipc.open_stream(piece).read_all()
        ids += found.column("doc_id").to_pylist()
        texts += found.column("text").to_pylist()
    return ids, texts


def listed(split):
    """The documents of each segment in pieces: segment, place of the first, ids and texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Splits as the sender does, so that segments are the same; texts travel as texts.
        held: list[str | None] = []

        def remembered(text: str | None) -> list[bytes]:
            held.append(text)
            return split(text)

        for number, ids, _ in segments(batches, remembered):
            texts, n = held[: len(ids)], len(ids)
            del held[:n]
            for a in range(0, n, PIECE_DOCS):
                b = min(n, a + PIECE_DOCS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()), pa.array([a], pa.int32()),
                        pa.array([pack_documents(ids[a:b], texts[a:b])], pa.binary()),
                    ],
                    names=["segment", "place", "docs"],
                )

    return rows


def with_counts(
    docs: DataFrame, split, digest: Digest, use, schema: str, chars: int, key_bits: int = 64
) -> DataFrame:
    """``use(number, ids, word lists, digest of them, counts by kind)`` for every segment.

    ``docs`` (doc_id, text) must be a stored table, so that reading it twice cuts the same
    segments; a segment whose counts do not fit its keys stops the job. Keys of a digest
    are numbers below 2 to the power of ``key_bits``.
    """
    counted = (
        small_batches(docs).mapInArrow(sender(split, digest, bucket_bits(chars), key_bits), SENT)
        .groupBy("key").applyInArrow(add_up, SENT)
        .select(F.col("segment").alias("at"), "key", "counts")
    )

    def cogrouped(rows: pa.Table, found: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # workers live on and would keep it
        rows = rows.sort_by("place")
        found = found.sort_by("key")
        ids, texts = unpack_documents(rows.column("docs").to_pylist())
        words = [split(t) for t in texts]
        own = digest(words)
        totals = {kind: [] for kind in sent_kinds(own)}
        for key, counts in zip(found.column("key").to_pylist(), found.column("counts").to_pylist()):
            totals[key >> 40].append(unpack_numbers(counts))
        joined = {k: np.concatenate(v) if v else np.zeros(0, np.uint64) for k, v in totals.items()}
        if any(len(joined[k]) != len(own[k][0]) for k in joined):
            raise ValueError("the documents were read in another order the second time")
        number = rows.column("segment")[0].as_py() if len(rows) else 0
        return use(number, ids, words, own, joined)

    return (
        docs.mapInArrow(listed(split), "segment long, place int, docs binary")
        .groupBy("segment").cogroup(counted.groupBy("at"))
        .applyInArrow(cogrouped, schema)
    )
