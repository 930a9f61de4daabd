"""Ranked lexical search with the Best Position Algorithm over impact-ordered lists.

Documents are cut into segments. A segment is one stored row with the postings of all asked
terms. Its lists, ordered by impact, are read in step from the top; a document met in one
list is looked up in all others at once, and every place so found is marked as seen. The
best position of a list is the end of its run of seen places from the top, so its impact
bounds what an unseen document can still get there. Reading stops when the sum of these
bounds lies strictly below the score of the last wanted rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartlake.llm.decontamination import ascii_words
from chartlake.llm.packing import flat, letter_words, segments
from chartlake.llm.shared import chosen, small_batches, staged

SEGMENT_WORDS = 2_000_000
# (item, term) pairs that are asked at once; more are asked slice by slice.
PAIRS = 1_000_000
# Places read from each list in the first step; each further step reads twice as many.
FIRST_STEP = 16
MERGE_CELLS = 64

INDEX = (
    "n_docs long, n_terms long, ids array<long>, lengths array<int>, "
    "terms array<int>, counts array<int>, docs binary, times binary"
)
FOUND = "item int, doc_id long, score long"


def indexer(vocabulary: list[bytes]):
    """A task that gives one row per segment: its documents and the postings of the terms."""
    place = {term: i for i, term in enumerate(vocabulary)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, words in segments(batches, letter_words, SEGMENT_WORDS):
            encoded, lengths = flat(words)
            number = np.array([place.get(w, -1) for w in encoded.dictionary.to_pylist()], np.int64)
            codes = number[encoded.indices.to_numpy()] if len(number) else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(ids)), lengths)[codes >= 0]
            pairs, times = np.unique(codes[codes >= 0] * len(ids) + owner, return_counts=True)
            terms, counts = np.unique(pairs // len(ids), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())]),
                    pa.array([ids], pa.list_(pa.int64())), pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([terms.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([(pairs % len(ids)).astype("<u4").tobytes()]),
                    pa.array([times.astype("<u4").tobytes()]),
                ],
                names=["n_docs", "n_terms", "ids", "lengths", "terms", "counts", "docs", "times"],
            )

    return index


class Lists:
    """The impact lists of one segment. Documents are numbered by ascending id."""

    def __init__(self, row: dict, weights: np.ndarray, n_all: int, terms_all: int):
        order = sorted(range(len(row["ids"])), key=lambda i: (row["ids"][i] is None, row["ids"][i] or 0))
        self.ids = [row["ids"][i] for i in order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        lengths = np.array(row["lengths"], np.int64)
        length = 100 - 50 + (50 * lengths * n_all) // max(terms_all, 1)
        docs = np.frombuffer(row["docs"], "<u4").astype(np.int64)
        times = np.frombuffer(row["times"], "<u4").astype(np.int64)
        counts = np.array(row["counts"], np.int64)
        weight = np.repeat(weights[np.array(row["terms"], np.int64)], counts)
        impacts = weight * ((1_000_000_000 * times) // (1000 * times + 20 * length[docs]))
        of = np.repeat(np.arange(len(counts)), counts)
        docs = rank[docs]
        by_doc = np.lexsort((docs, of))
        self.docs, self.impacts = docs[by_doc], impacts[by_doc]
        by_impact = np.lexsort((self.docs, -self.impacts, of))
        starts = np.concatenate(([0], np.cumsum(counts)))
        # For each posting by document: its place in its list by impact.
        self.places = np.empty(len(docs), np.int64)
        self.places[by_impact] = np.arange(len(docs)) - np.repeat(starts[:-1], counts)
        self.sorted_docs, self.sorted_impacts = self.docs[by_impact], self.impacts[by_impact]
        self.range_of = {t: (int(starts[i]), int(starts[i + 1])) for i, t in enumerate(row["terms"])}

    def pick(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of these terms start, and how long they are."""
        own = [self.range_of[t] for t in terms if t in self.range_of]
        starts = np.array([a for a, _ in own], np.int64)
        return starts, np.array([b for _, b in own], np.int64) - starts


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def best_positions(lists: Lists, terms: list[int], k: int, floor: int = 0) -> tuple[list[tuple[int, int]], int]:
    """The ``k`` best (score, document), and how many documents were scored.

    Only documents that can reach ``floor`` are surely among them. Equal scores go by
    document number.
    """
    starts, lengths = lists.pick(terms)
    m = len(starts)
    if not m:
        return [], 0
    # The lists' postings by document under one another: key = list number and document.
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    own = ranges(starts, lengths)
    docs, impacts, places = lists.docs[own], lists.impacts[own], lists.places[own]
    n = len(lists.ids)
    keys = np.repeat(np.arange(m), lengths) * n + docs
    seen = np.zeros(len(own) + 1, bool)
    best = np.zeros(m, np.int64)  # length of the run of seen places of each list
    scored = np.zeros(n, bool)
    top_scores, top_docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step = 0, FIRST_STEP
    while True:
        here = np.clip(lengths - depth, 0, step)
        if not here.any():
            break
        met = np.unique(lists.sorted_docs[ranges(starts + depth, here)])
        met = met[~scored[met]]
        scored[met] = True
        if len(met):  # direct access to all lists
            wanted = (np.arange(m)[:, None] * n + met[None, :]).ravel()
            at = np.searchsorted(keys, wanted)
            at[at == len(keys)] = len(keys) - 1
            hit = keys[at] == wanted
            totals = np.where(hit, impacts[at], 0).reshape(m, -1).sum(0)
            which = np.repeat(np.arange(m), len(met))[hit]
            seen[offsets[which] + places[at[hit]]] = True
            top_scores, top_docs = np.concatenate((top_scores, totals)), np.concatenate((top_docs, met))
            order = np.lexsort((top_docs, -top_scores))[:k]
            top_scores, top_docs = top_scores[order], top_docs[order]
        depth, step = depth + step, step * 2
        best = np.maximum(best, np.minimum(depth, lengths))
        for i in np.flatnonzero(best < lengths):
            rest = seen[offsets[i] + best[i] : offsets[i + 1]]
            run = int(np.argmin(rest))
            best[i] += len(rest) if rest[run] else run
        # An unseen document can get no more than the impact at the best position of each
        # list, and nothing from a list that has been seen to its end.
        open_ = best < lengths
        bound = int(lists.sorted_impacts[starts[open_] + best[open_] - 1].sum())
        last = int(top_scores[-1]) if len(top_scores) == k else 0
        if bound < max(last, floor, 1):
            break
    found = [(int(s), int(d)) for s, d in zip(top_scores, top_docs) if s > 0]
    return found, int(scored.sum())


def searcher(items: list[list[int]], weights: np.ndarray, n_all: int, terms_all: int, k: int):
    """A task that gives, for each item, the ``k`` best documents of all its segments."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple[int, bool, int]]] = [[] for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                lists = Lists(batch.slice(i, 1).to_pylist()[0], weights, n_all, terms_all)
                for item, terms in enumerate(items):
                    so_far = kept[item]
                    floor = -so_far[-1][0] if len(so_far) == k else 0
                    found, _ = best_positions(lists, terms, k, floor)
                    if found:
                        new = [(-s, lists.ids[d] is None, lists.ids[d] or 0) for s, d in found]
                        kept[item] = sorted(so_far + new)[:k]
        rows = [(i, None if none else d, -s) for i, own in enumerate(kept) for s, none, d in own]
        if rows:
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
                names=["item", "doc_id", "score"],
            )

    return search


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item_id, term)."""
    return chosen(items, item_id=id_col, text=text_col).select(
        "item_id", F.explode(ascii_words(F.col("text"))).alias("term")
    ).distinct()


def ranked(found: DataFrame, group: list[str | Column], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def weight(n_all: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_all + 2) / (2 * holding + 1)))


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pairs: int = PAIRS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score for each item.

    Terms are runs of digits, letters and non-ASCII characters with A-Z in lower case. Equal
    scores go by ascending id, null ids last. Documents of score 0 are not listed.

    Null, empty and wordless texts have no terms; such items have no rows. Rows of items with
    the same id, null included, are one item with the terms of all. Every row of ``docs`` is a
    document, so a repeated row takes a rank of its own. Empty tables give no rows. Other
    columns are ignored. ``docs`` must be a stored table with integer ids.

    Items are asked in slices of about ``pairs`` of their terms, so that what goes to the
    tasks stays bounded; one item is never cut.
    """
    rows = small_batches(chosen(docs, doc_id=id_col, text=text_col))
    asked = staged(item_terms(items, item_col, item_text_col), "asked-terms")
    slices = max(1, math.ceil(asked.count() / pairs))
    results = [
        _search_slice(rows, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == i), k)
        for i in range(slices)
    ]
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def _search_slice(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = rows.sparkSession
    pairs = [(r["item_id"], bytes(r["term"])) for r in asked.collect()]  # about PAIRS of them
    vocabulary = sorted({term for _, term in pairs})
    number = {term: i for i, term in enumerate(vocabulary)}
    terms_of: dict = {}
    for item, term in pairs:
        terms_of.setdefault(item, []).append(number[term])

    index = staged(rows.mapInArrow(indexer(vocabulary), INDEX), "impact-lists")
    n_all, terms_all = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    held = (
        index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        .groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.counts").alias("n")).collect()
    )
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    for r in held:
        weights[r["term"]] = weight(n_all, r["n"])

    order = list(terms_of)
    listed = [sorted(t for t in terms_of[i] if weights[t] > 0) for i in order]
    best = index.mapInArrow(searcher(listed, weights, n_all or 0, terms_all or 0, k), FOUND)
    # Cells of an item are cut to the best first, so that no task ranks all finds of an item.
    cells = ranked(best, ["item", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_CELLS))], k).drop("rank")
    item_type = dict(asked.dtypes)["item_id"]
    names = spark.createDataFrame(list(enumerate(order)), f"item int, item_id {item_type}")
    return ranked(cells, ["item"], k).join(names, "item").select("item_id", "rank", "doc_id", "score")
