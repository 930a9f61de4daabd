"""Passages that repeat across documents, by counting hashes of windows.

No suffix array is built. Of every run of 39 consecutive 12-word grams the one with the
smallest hash is a minimiser, so every passage of 50 words holds one, and copies of a
passage hold the same. Minimisers are counted in hash buckets; one that a single document
has cannot lie in a repeat. Around the others the hashes of all 50-word windows are counted
in buckets in turn, and windows that repeat are merged to passages. Words are not compared:
windows are equal if their 64-bit hashes are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chartlake.llm.counting import add_up, bucket_bits, by_bucket, text_chars, with_counts
from chartlake.llm.packing import (
    flat,
    mixed,
    pack_numbers,
    pack_sorted,
    shingle_hashes,
    space_words,
    unpack_numbers,
    unpack_sorted,
    word_hashes,
)
from chartlake.llm.shared import chosen

PASSAGE = 50
GRAM = 12
FACTOR = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64

FOUND = (
    "segment long, key long, data binary, counts binary, starts binary, "
    "ids array<long>, lengths array<long>"
)
FOUND_SCHEMA = pa.schema([
    ("segment", pa.int64()), ("key", pa.int64()), ("data", pa.binary()), ("counts", pa.binary()),
    ("starts", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :])


def distinct_keys(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and in how many documents each stands."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.unique(h[new], return_counts=True)


def sampled_suffixes(passage: int, gram: int):
    def digest(words: list[list[bytes]]) -> dict:
        width = passage - gram + 1
        encoded, lengths = flat(words)
        nothing = np.zeros(0, np.int64)
        hashed = word_hashes(encoded) if len(encoded) else np.zeros(0, np.uint64)
        grams, docs = shingle_hashes(hashed, lengths, gram, short_too=False)
        if len(grams) < width:
            return {0: (hashed, lengths, nothing, nothing, nothing.astype(np.uint64)), 1: (grams[:0], nothing)}
        bits = np.uint64(max(24, len(grams).bit_length()))
        at = np.arange(len(grams), dtype=np.uint64)
        least = least_of((grams >> bits << bits) | at, width)
        inside = docs[: len(least)] == docs[width - 1 :]
        first = np.flatnonzero(inside)  # first gram of each whole passage window
        sample = (least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # From the number of a gram to the number of its first word.
        per_doc = np.maximum(lengths - gram + 1, 0)
        shift = (np.cumsum(lengths) - lengths) - (np.cumsum(per_doc) - per_doc)
        kept = np.unique(sample)
        return {
            0: (hashed, lengths, first + shift[docs[first]], docs[first], grams[sample]),
            1: distinct_keys(grams[kept], docs[kept]),
        }

    return digest


def window_hashes(words: np.ndarray, starts: np.ndarray, passage: int) -> np.ndarray:
    def powers(factor: int) -> np.ndarray:
        return np.cumprod(np.append(np.uint64(1), np.full(len(words), factor, np.uint64)))

    up, down = powers(FACTOR), powers(pow(FACTOR, -1, 1 << 64))
    sums = np.append(np.uint64(0), np.cumsum(words * down[:-1]))
    return mixed((sums[starts + passage] - sums[starts]) * up[starts])


def windows_of(number: int, ids: list, keys: dict, totals: dict, passage: int, bits: int) -> pa.Table:
    """Of one segment: the windows around shared suffixes, by bucket, and its documents."""
    hashed, lengths, starts, docs, grams = keys[0]
    rows = [(number, -1 - number % 997, None, None, None, ids, lengths.tolist())]
    if len(starts):
        shared = totals[1][np.searchsorted(keys[1][0], grams)] > 1
        starts, docs = starts[shared], docs[shared]
        hashes = window_hashes(hashed, starts, passage)
        unique, counts = distinct_keys(hashes, docs)
        order = np.argsort(hashes, kind="stable")
        runs = np.diff(np.append(np.searchsorted(hashes[order], unique), len(hashes)))
        ends = np.concatenate(([0], np.cumsum(runs)))
        for bucket, a, b in by_bucket(unique, bits):
            # How many starts each window has, then the starts themselves.
            listed = np.concatenate((runs[a:b], starts[order][ends[a] : ends[b]]))
            rows.append((number, bucket, pack_sorted(unique[a:b]), pack_numbers(counts[a:b]), pack_numbers(listed), None, None))
    return pa.Table.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(zip(*rows), FOUND_SCHEMA)], schema=FOUND_SCHEMA
    )


def shared_windows(table: pa.Table) -> pa.Table:
    """Of one bucket: the starts of windows that stand in several documents."""
    if table.column("key")[0].as_py() < 0:
        return table
    totals = add_up(table.select(["segment", "key", "data", "counts"])).column("counts").to_pylist()
    rows = []
    for number, total, listed in zip(
        table.column("segment").to_pylist(), totals, table.column("starts").to_pylist()
    ):
        several = unpack_numbers(total) > 1
        listed = unpack_numbers(listed).astype(np.int64)
        runs, starts = listed[: len(several)], listed[len(several) :]
        kept = starts[np.repeat(several, runs)]
        if len(kept):
            rows.append((number, 0, None, None, pack_sorted(np.sort(kept)), None, None))
    columns = list(zip(*rows)) if rows else [()] * len(FOUND_SCHEMA)
    return pa.Table.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, FOUND_SCHEMA)], schema=FOUND_SCHEMA
    )


def passages_of(table: pa.Table, passage: int) -> pa.Table:
    """Of one segment: its repeated windows merged to passages, a row each."""
    ids, lengths, starts = [], np.zeros(0, np.int64), [np.zeros(0, np.uint64)]
    for key, blob, own_ids, own_lengths in zip(
        *(table.column(c).to_pylist() for c in ("key", "starts", "ids", "lengths"))
    ):
        if key < 0:
            ids, lengths = own_ids, np.array(own_lengths, np.int64)
        else:
            starts.append(unpack_sorted(blob))
    starts = np.unique(np.concatenate(starts)).astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    owner = np.searchsorted(begins + lengths, starts, side="right")
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > starts[:-1] + passage) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    docs = owner[first]
    return pa.table(
        {
            "doc_id": pa.array([ids[d] for d in docs], pa.int64()),
            "first_word": pa.array(starts[first] - begins[docs], pa.int64()),
            "n_words": pa.array(starts[last] + passage - starts[first], pa.int64()),
        }
    )


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE, gram: int = GRAM
) -> DataFrame:
    """One row per repeated passage: doc_id, first_word, n_words.

    Words stand between ASCII white space, A-Z in lower case. A word belongs to a repeated
    passage if some window of ``passage`` words around it stands in at least one other
    document as well; overlapping and touching windows are one passage.

    Null, empty and short texts have no passages. Repeats inside one document do not
    count; repeated rows are different documents, so their whole text repeats. Null ids
    stay null. An empty table gives no rows. Other columns are ignored. The input must be
    a stored table.
    """
    rows = chosen(docs, doc_id=id_col, text=text_col)
    chars = text_chars(rows)
    bits = bucket_bits(chars)

    def use(number, ids, words, keys, totals) -> pa.Table:
        return windows_of(number, ids, keys, totals, passage, bits)

    def merged(table: pa.Table) -> pa.Table:
        return passages_of(table, passage)

    return (
        with_counts(rows, space_words, sampled_suffixes(passage, gram), use, FOUND, chars)
        .groupBy("key").applyInArrow(shared_windows, FOUND)
        .groupBy("segment").applyInArrow(merged, "doc_id long, first_word long, n_words long")
    )
