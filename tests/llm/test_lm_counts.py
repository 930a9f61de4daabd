"""Counts outside a document, for the scores of the language model."""

from __future__ import annotations

from collections import Counter

import numpy as np
from llm_helpers import prose

from chartlake.llm import lm
from chartlake.llm.packing import space_words


def test_counts_outside_a_document_take_one_sort(monkeypatch):
    """Before, totals were found by a binary search for every word beside the sort for its own counts."""
    words = [space_words(t) for t in (prose(1, 300, 40), "", prose(2, 500, 40), "a b a b")]
    keys = lm.gram_counts(3)(words)
    totals = {n: keys[n][1].astype(np.uint64) for n in (1, 2, 3)}
    want = []  # (n-gram's count in all documents) - (in its own), by plain counting
    for n in (1, 2, 3):
        own = [Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for w in words]
        every = sum(own, Counter())
        want.append([
            every[g] - c[g] for c, w in zip(own, words) for g in (tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        ])

    def searched(*_):
        raise AssertionError("binary search for every n-gram")

    monkeypatch.setattr(np, "searchsorted", searched)
    for n, (hashes, docs) in enumerate(keys[0], 1):
        assert lm.other_counts(hashes, docs, totals[n]).tolist() == want[n - 1]
    lm.score_segment(words, keys, totals, 3, 0.4, 804)
