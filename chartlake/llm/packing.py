"""Words and packed arrays for the operators that work on batches of documents in Python.

A segment is a run of whole documents with about a million words. Its rows travel as
packed arrays, which keeps a billion small records out of the shuffle. Segments are cut
from the rows as they come, so the input must be a stored table, which a repeated task
reads in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext

SEGMENT_WORDS = 1_000_000
SEGMENT_DOCS = 60_000

# Upper-case ASCII to lower case; what is no digit, letter or non-ASCII byte to a blank.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def letter_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split() if text else []


def segments(
    batches: Iterator[pa.RecordBatch], split, most: int = SEGMENT_WORDS
) -> Iterator[tuple[int, list, list]]:
    """(segment number, ids, word lists) of runs of documents; columns: id, text.

    A segment ends with the document that brings it to ``most`` words.
    """
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    ids, words, total = [], [], 0
    for batch in batches:
        own = batch.column(0).to_pylist()
        texts = batch.column(1)
        for i, row in enumerate(own):
            found = split(texts[i].as_py())
            ids.append(row)
            words.append(found)
            total += len(found)
            if total >= most or len(ids) >= SEGMENT_DOCS:
                yield number, ids, words
                number, ids, words, total = number + 1, [], [], 0
                pa.default_memory_pool().release_unused()
    if ids:
        yield number, ids, words


def flat(words: list[list[bytes]]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words as one dictionary array, and how many each document has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined: list[bytes] = []
    for own in words:
        joined += own
    return pa.array(joined, pa.binary()).dictionary_encode(), lengths


def word_hashes(encoded: pa.DictionaryArray) -> np.ndarray:
    """A 64-bit hash for each word of the array."""
    words = encoded.dictionary.to_numpy(zero_copy_only=False)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return each[encoded.indices.to_numpy()]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(
    words: np.ndarray, lengths: np.ndarray, k: int, short_too: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each document, and the document of each.

    With ``short_too`` a document of fewer words, but not none, has one shingle, its
    whole sequence; these come last.
    """
    factors = mixed(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    n = len(words)
    if n >= k:
        whole = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            whole += words[i : n - k + 1 + i] * factors[i]
        inside = owner[: n - k + 1] == owner[k - 1 :]
        hashes, docs = mixed(whole[inside]), owner[: n - k + 1][inside]
    else:
        hashes, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    if short_too and len(short):
        each = np.array(
            [(words[starts[d] : starts[d] + lengths[d]] * factors[: lengths[d]]).sum() for d in short],
            np.uint64,
        )
        each = mixed(each + lengths[short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        hashes, docs = np.concatenate((hashes, each)), np.concatenate((docs, short))
    return hashes, docs


def binary_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``values`` cut into consecutive byte strings of ``counts`` values each."""
    offsets = np.concatenate(([0], np.cumsum(counts))) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(),
        len(counts),
        [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())],
    )


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned numbers by byte planes, as many as the largest needs; small ones compress."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + planes.tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T
    wide = np.zeros((len(planes), 8), np.uint8)
    wide[:, :width] = planes
    return wide.reshape(-1).view("<u8").astype(np.uint64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted numbers as the first and the steps."""
    first = values[:1].astype("<u8").tobytes()
    return first + pack_numbers(np.diff(values)) if len(values) else b""


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    return np.cumsum(np.concatenate((np.frombuffer(data, "<u8", 1), unpack_numbers(data[8:]))), dtype=np.uint64)
