"""Benchmark decontamination through a distributed positional inverted index.

The index is a stored table: for each segment of documents and each term, the slots at
which the term stands. Slots number the words of a segment's documents in a row, with a
gap between documents. A phrase is found by intersecting the slot lists of its terms,
shifted by their offsets, from the rarest term on; most phrases end after two lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.llm.packing import binary_column, flat, letter_words, segments
from chartlake.llm.shared import chosen, small_batches, staged

WINDOW = 10
# Words of a segment of the index; smaller ones take less memory, larger ones fewer rows.
SEGMENT_WORDS = 200_000
# Documents of a segment are this many slots apart, more than any proximity asked for.
GAP = 64
# Asked terms up to this number go to the indexing tasks; with more, all terms are indexed.
MOST_TERMS = 500_000

INDEX = "segment long, term binary, n long, slots binary, ids array<long>, sizes array<long>"


def indexer(asked: set[bytes] | None):
    """A task that gives the postings of each segment, of the asked terms or of all.

    A row without term lists the documents of the segment.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, words in segments(batches, letter_words, SEGMENT_WORDS):
            encoded, lengths = flat(words)
            codes, terms = encoded.indices.to_numpy(), encoded.dictionary
            slots = np.arange(len(codes), dtype=np.int64) + np.repeat(np.arange(len(lengths)), lengths) * GAP
            if asked is not None:
                wanted = np.array([t in asked for t in terms.to_pylist()], bool)
                hit = wanted[codes] if len(wanted) else np.zeros(0, bool)
                slots, terms = slots[hit], terms.filter(pa.array(wanted, pa.bool_()))
                codes = (np.cumsum(wanted) - 1)[codes[hit]]
            order = np.argsort(codes, kind="stable")
            counts = np.bincount(codes, minlength=len(terms))
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n + 1, number)),
                    pa.concat_arrays([terms, pa.nulls(1, pa.binary())]),
                    pa.array(np.append(counts, 0).astype(np.int64)),
                    pa.concat_arrays([binary_column(slots[order].astype("<u4"), counts), pa.nulls(1, pa.binary())]),
                    pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64()))]),
                    pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64()))]),
                ],
                names=["segment", "term", "n", "slots", "ids", "sizes"],
            )

    return index


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", asked: set[bytes] | None = None
) -> DataFrame:
    """The stored index of the words of ``docs``, itself a stored table.

    With ``asked`` it holds these terms only, which is all that one search needs; an index
    for many searches is built without.
    """
    rows = small_batches(chosen(docs, doc_id=id_col, text=text_col))
    return staged(rows.mapInArrow(indexer(asked), INDEX), "postings")


def asked_terms(phrases: DataFrame) -> set[bytes] | None:
    """The distinct terms of the phrases; ``None`` if there are more than ``MOST_TERMS``."""
    terms = phrases.select(F.explode("terms").alias("term")).distinct().limit(MOST_TERMS + 1).collect()
    return {bytes(r["term"]) for r in terms} if len(terms) <= MOST_TERMS else None


def ascii_words(text: Column) -> Column:
    """Lower-case words of letters, digits and non-ASCII characters, as bytes."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    return F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda w: w.cast("binary"))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, terms): every window of consecutive words; a short item is one window."""
    words = chosen(items, item_id=id_col, text=text_col).select(
        F.col("item_id").cast("string").alias("item_id"), ascii_words(F.col("text")).alias("words")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - window + 1))
    return words.filter(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("terms")
    )


def slots_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").astype(np.int64)


def intersect(postings: dict[bytes, np.ndarray], terms: list[bytes], slack: int = 0) -> np.ndarray:
    """Slots at which the phrase of ``terms`` starts, rarest term first.

    With ``slack``, the rarest term anchors the match and each other term may stand up to
    so many slots away from its place.
    """
    order = sorted(range(len(terms)), key=lambda i: len(postings.get(terms[i], ())))
    starts = None
    for i in order:
        found = postings.get(terms[i])
        if found is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = found - i
            continue
        at = np.searchsorted(found, starts + i - slack)
        at[at == len(found)] = len(found) - 1
        ahead = found[at] - (starts + i)
        starts = starts[(ahead >= -slack) & (ahead <= slack)]
        if not len(starts):
            break
    return starts


def covered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Distinct slots inside the runs that begin at ``starts``."""
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.unique(np.repeat(starts, lengths) + np.concatenate([np.arange(n) for n in lengths]))


def search_segment(postings: pa.Table, phrases: pa.Table, slack: int) -> pa.Table:
    """Of one segment: a row per document, with its hit words and the phrases found."""
    rows = postings.to_pydict()
    lists, ids, sizes = {}, [], []
    for term, slots, own_ids, own_sizes in zip(rows["term"], rows["slots"], rows["ids"], rows["sizes"]):
        if term is None:
            ids, sizes = own_ids, np.array(own_sizes, np.int64)
        else:
            lists[term] = slots_of(slots)
    first = np.concatenate(([0], np.cumsum(sizes + GAP)))[:-1] if len(ids) else np.zeros(0, np.int64)
    starts, lengths, which = [], [], []
    for phrase, terms in zip(phrases.column("phrase").to_pylist(), phrases.column("terms").to_pylist()):
        found = intersect(lists, terms, slack)
        if slack and len(found):  # near the edge of a document an anchor's start lies in the gap
            owner = np.searchsorted(first, found + len(terms), side="right") - 1
            found = np.clip(found, first[owner], None)
        if len(found):
            starts.append(found)
            lengths.append(np.full(len(found), len(terms)))
            which.append(np.full(len(found), phrase, object))
    n_hit = np.zeros(len(ids), np.int64)
    phrases_of: list[list[bytes]] = [[] for _ in ids]
    if starts:
        starts, lengths, which = map(np.concatenate, (starts, lengths, which))
        owner = np.searchsorted(first, starts, side="right") - 1
        hit = covered(starts, lengths)
        of = np.searchsorted(first, hit, side="right") - 1
        inside = hit - first[of] < sizes[of]
        n_hit = np.bincount(of[inside], minlength=len(ids))
        for d, phrase in set(zip(owner.tolist(), which.tolist())):
            phrases_of[d].append(phrase)
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "phrases": pa.array([sorted(x) for x in phrases_of], pa.list_(pa.binary())),
        }
    )


def search(index: DataFrame, phrases: DataFrame, slack: int = 0, narrow: bool = False) -> DataFrame:
    """(row, doc_id, n_words, n_hit, phrases): exact or proximity matches of all phrases.

    ``phrases`` has distinct rows (phrase, terms). A segment gets the postings of the
    phrases' terms, and those phrases of which it has the term that is rarest in the whole
    index; nothing is broadcast. ``narrow``: the index holds the asked terms only.
    """
    longest = phrases.agg(F.max(F.size("terms"))).first()[0] or 0
    if slack and slack + longest > GAP:
        raise ValueError(f"a slack of {slack} would reach from one document into the next")
    terms = phrases.select(F.explode("terms").alias("term")).distinct()
    listed = index.filter("term is null").select("segment", "term", "slots", "ids", "sizes")
    asked = index.filter("term is not null").join(terms, "term", "left_semi")
    needed = index if narrow else staged(
        asked.select("segment", "term", "n", "slots", "ids", "sizes").unionByName(
            listed.withColumn("n", F.lit(0).cast("long"))
        ),
        "asked",
    )
    frequency = needed.filter("term is not null").groupBy("term").agg(F.sum("n").alias("n"))
    # The rarest term of each phrase; a term that never occurs leaves no postings to meet.
    rarest = (
        phrases.withColumn("term", F.explode(F.array_distinct("terms")))
        .join(frequency, "term", "left")
        .groupBy("phrase")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))["term"].alias("term"))
    )
    sent = (
        needed.filter("term is not null").select("segment", "term")
        .join(rarest, "term")
        .join(phrases, "phrase")
        .select(F.col("segment").alias("at"), "phrase", "terms")
    )

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_segment(left, right, slack)

    return (
        needed.select("segment", "term", "slots", "ids", "sizes")
        .groupBy("segment")
        .cogroup(sent.groupBy("at"))
        .applyInArrow(found, "doc_id long, n_words long, n_hit long, phrases array<binary>")
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slack: int = 0,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, contaminated.

    ``items`` is the sorted list of ids whose windows occur in the document. With
    ``slack`` the windows also match in proximity; see :func:`intersect`.

    A null, empty or wordless text has no words and is not contaminated; such items have
    no windows. Null item ids count as one item of their own, written as an empty id.
    Repeated documents give a row each, repeated items count once. Empty tables: no
    documents give no rows; no items leave everything clean. Other columns are ignored.
    ``docs`` must be a stored table. A slack that would reach into the next document, more
    than ``GAP`` less the longest window, is refused.
    """
    windows = staged(
        item_windows(items, item_col, item_text_col, window)
        .withColumn("unnamed", F.col("item_id").isNull())
        .withColumn("phrase", F.unhex(F.md5(F.array_join(F.transform("terms", lambda t: t.cast("string")), " "))))
        .distinct(),
        "windows",
    )
    phrases = windows.select("phrase", "terms").dropDuplicates(["phrase"])
    asked = asked_terms(phrases)
    found = staged(
        search(build_index(docs, id_col, text_col, asked), phrases, slack, narrow=asked is not None), "found"
    )
    clean = found.filter(F.size("phrases") == 0).select(
        "doc_id", "n_words", "n_hit", F.array().cast("array<string>").alias("items")
    )
    hit = (
        found.filter(F.size("phrases") > 0)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("phrase", F.explode("phrases"))
        .drop("phrases")
        .join(windows.select("phrase", F.coalesce("item_id", F.lit("")).alias("item_id"), "unnamed"), "phrase")
        .groupBy("row", "doc_id", "n_words", "n_hit", "item_id", "unnamed")
        .agg(F.count("*"))
        .groupBy("row", "doc_id", "n_words", "n_hit")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
        .drop("row")
    )
    return clean.unionByName(hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"),
    )
