"""Stupid-backoff language-model scores of documents, computed relationally.

N-gram counts of the whole corpus are summed in hash partitions, joined back to the
n-grams of each document and summed per document. A document is scored against all
others: its own counts are subtracted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.llm.counting import text_chars, with_counts
from chartlake.llm.packing import flat, shingle_hashes, space_words, word_hashes
from chartlake.llm.shared import WORD, chosen

ORDER = 2
BACKOFF = 0.4


def grams(words: list[list[bytes]], order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n from 1: hashes of the n-grams in text order, and their documents."""
    encoded, lengths = flat(words)
    if not len(encoded):
        return [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * order
    hashed = word_hashes(encoded)
    return [shingle_hashes(hashed, lengths, n, short_too=False) for n in range(1, order + 1)]


def gram_counts(order: int):
    def digest(words: list[list[bytes]]) -> dict:
        found = grams(words, order)
        return {0: found} | {
            n: np.unique(hashes, return_counts=True) for n, (hashes, _) in enumerate(found, 1)
        }

    return digest


def other_counts(hashes: np.ndarray, docs: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """How often each n-gram stands in other documents.

    ``totals`` belong to the sorted distinct hashes; n-grams come by document. One sort
    finds both the total of an n-gram and how often its own document has it.
    """
    if not len(hashes):
        return np.zeros(0, np.int64)
    order = np.argsort(hashes, kind="stable")
    h, d = hashes[order], docs[order]
    new = np.concatenate(([True], h[1:] != h[:-1]))
    first = np.flatnonzero(new | np.concatenate(([True], d[1:] != d[:-1])))
    runs = np.diff(np.append(first, len(h)))
    others = totals.astype(np.int64)[(np.cumsum(new) - 1)[first]] - runs
    out = np.empty(len(h), np.int64)
    out[order] = np.repeat(others, runs)
    return out


def score_segment(words, keys, totals, order: int, backoff: float, corpus: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, sum of natural logarithms) of each document of a segment."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    scores = np.zeros(len(words))
    if not lengths.sum():
        return lengths, scores
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    others = []  # for each n: the count outside the document of the n-gram ending at a word
    for n, (hashes, docs) in enumerate(keys[0], 1):
        full = np.zeros(len(owner), np.int64)
        full[place >= n - 1] = other_counts(hashes, docs, totals[n])
        others.append(full)
    rest = np.maximum(corpus - lengths[owner], 1)
    # A word that no other document has counts as half an occurrence.
    probability = np.maximum(others[0], 0.5) / rest
    for n in range(2, order + 1):
        history = np.zeros(len(owner), np.int64)
        history[1:] = others[n - 2][:-1]
        seen = (place >= n - 1) & (others[n - 1] > 0)
        backed = np.where(place >= n - 1, backoff * probability, probability)
        probability = np.where(seen, others[n - 1] / np.maximum(history, 1), backed)
    np.add.at(scores, owner, np.log(probability))
    return lengths, scores


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
    backoff: float = BACKOFF,
) -> DataFrame:
    """One row per document: doc_id, n_words, log_score, mean_score.

    The score of a word is the share of its n-gram among those of its history in all other
    documents, or ``backoff`` times the score with a shorter history where there is none.
    ``log_score`` adds natural logarithms, ``mean_score`` divides by the number of words.
    At the start of a document histories are as long as the text allows. Copies of a
    document count as other documents.

    Null, empty and blank texts have no words, score 0 and a null mean. Null ids stay.
    Repeated rows give a row each. An empty table gives no rows. Other columns are
    ignored. The input must be a stored table.
    """
    rows = chosen(docs, doc_id=id_col, text=text_col)
    corpus = rows.agg(F.sum(F.expr(f"regexp_count(text, r'{WORD}')"))).first()[0] or 0

    def use(number, ids, words, keys, totals) -> pa.Table:
        lengths, scores = score_segment(words, keys, totals, order, backoff, corpus)
        return pa.table(
            {"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(lengths), "log_score": pa.array(scores)}
        )

    return with_counts(
        rows, space_words, gram_counts(order), use, "doc_id long, n_words long, log_score double", text_chars(rows)
    ).withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
