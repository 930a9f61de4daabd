"""What the counting of shingles sends, and that fewer bits of a hash find the same."""

from __future__ import annotations

import pyarrow as pa
import pytest
from llm_helpers import prose, stored  # noqa: F401

from chartlake.llm import counting
from chartlake.llm import ngram_join as join
from chartlake.llm.packing import segments, space_words


def batch(texts):
    return pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}
    )


def test_shingles_are_sent_in_few_bytes():
    """Before, a shingle that stands alone took more than six bytes: its whole hash, as steps."""
    texts = [prose(i, 500, 50_000) for i in range(40)]
    bits = join.frequency_bits(sum(map(len, texts)))
    send = counting.sender(space_words, join.shingle_frequencies(4, bits), 6, bits)
    rows = pa.Table.from_batches(send(iter([batch(texts)])))
    shingles = 40 * 497
    assert sum(map(len, rows.column("data").to_pylist())) < 4.5 * shingles


def test_texts_travel_compressed():
    texts = [prose(i, 500) for i in range(40)] + [None, "", "\U0001f600"]
    rows = pa.Table.from_batches(counting.listed(space_words)(iter([batch(texts)])))
    pieces = rows.column("docs").to_pylist()
    assert counting.unpack_documents(pieces) == (list(range(43)), texts)
    assert sum(map(len, pieces)) < 0.5 * sum(len(t or "") for t in texts)


def test_pieces_follow_the_segments(monkeypatch):
    monkeypatch.setattr(counting, "PIECE_DOCS", 3)
    monkeypatch.setattr(counting, "segments", lambda b, split: segments(b, split, 50))
    texts = [prose(i, 7) for i in range(40)]
    rows = pa.Table.from_batches(counting.listed(space_words)(iter([batch(texts)])))
    assert rows.num_rows > 13 and len(set(rows.column("segment").to_pylist())) == 5
    assert counting.unpack_documents(rows.column("docs").to_pylist())[1] == texts


@pytest.mark.parametrize("bits", [8, 12])
def test_frequencies_of_colliding_bits_find_the_same_components(stored, monkeypatch, bits):  # noqa: F811
    """With so few bits nearly every shingle passes as shared."""
    rows = [(i, prose(i, 60), "a") for i in range(30)]
    rows += [(100 + i, prose(i, 60) + " end", "a") for i in range(0, 30, 2)]
    rows += [(200 + i, prose(i, 30) + " " + prose(300 + i, 30), "a") for i in range(30)]
    docs = stored(rows)
    want = {i: i % 100 if 100 <= i < 200 else i for i, _, _ in rows}

    def found():
        return {r["doc_id"]: r["component_id"] for r in join.ngram_join(docs, words=4, percent=85).collect()}

    assert found() == want
    monkeypatch.setattr(join, "frequency_bits", lambda chars: bits)
    assert found() == want
