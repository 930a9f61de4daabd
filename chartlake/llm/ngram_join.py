"""Similarity join of documents on word n-grams by rare-first prefix filtering.

1. The document frequency of every shingle is counted over all documents and brought back
   (see :mod:`chartlake.llm.counting`). Shared shingles become tokens that sort rare-first;
   an unshared one cannot match, but it counts. Frequencies are counted by the first bits
   of a shingle's hash: now and then an unshared one passes as shared, and matches nothing.
2. A document whose prefix holds unshared shingles only has no partner and is done. The
   others become sets of tokens, one for each distinct word sequence.
3. Sets with an equal minimum hash are compared with a few leaders of their group, which
   joins most copies by verified links without making pairs of them.
4. The prefix join proper looks at tokens whose documents are still in different
   components: pairs are filtered by length, position and suffix, and verified once. It
   goes over one set of each component for a token first, then over all sets of the components
   that are still apart. Pairs inside a component cannot change it and are never made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.llm.components import components
from chartlake.llm.counting import bucket_bits, text_chars, with_counts
from chartlake.llm.packing import (
    binary_column,
    flat,
    mixed,
    shingle_hashes,
    space_words,
    word_hashes,
)
from chartlake.llm.shared import chosen, staged

WORDS = 4
PERCENT = 85
# Leaders a document is compared with in one group; only how early links are found depends on it.
LEADERS = 16
# Bits of a hash beyond those that number all shingles, by which shared ones are told.
SPARE_BITS = 8
SUFFIX_CELLS = 128

KEPT = "is_set boolean, doc_id long, name binary, size int, tokens binary, unshared int"


def least_overlap(size: int, other: int, percent: int) -> int:
    """The smallest intersection with which two sets of these sizes are similar."""
    return -(-percent * (size + other) // (100 + percent))


def prefix_length(size, percent: int):
    """Similar sets share a token among their first so many, in any common order."""
    return size - (percent * size + 99) // 100 + 1


def frequency_bits(chars: int) -> int:
    """Bits of a hash by which to count the shingles of texts of so many characters.

    There are fewer shingles than characters, so an unshared one has the same bits as some
    other with a probability below 2 to the power of -``SPARE_BITS``.
    """
    return min(64, max(32, bucket_bits(chars), chars.bit_length() + SPARE_BITS))


def shingle_frequencies(k: int, bits: int = 64):
    """Digest of a segment: its shingles, and how many different word sequences have each,
    by the first ``bits`` of its hash."""

    def digest(words: list[list[bytes]]) -> dict:
        places, names, seen, kept = [], [], {}, []
        for own in words:
            name = hashlib.blake2b(b" ".join(own), digest_size=16).digest()
            place = seen.setdefault(name, len(kept))
            if place == len(kept):
                kept.append(own)
                names.append(name)
            places.append(place)
        encoded, lengths = flat(kept)
        hashes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(encoded):
            hashes, owner = shingle_hashes(word_hashes(encoded), lengths, k)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        return {0: (places, names, hashes, owner), 1: np.unique(first_bits(hashes, bits), return_counts=True)}

    return digest


def first_bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def make_sets(ids: list, keys: dict, totals: dict, percent: int, bits: int = 64) -> pa.Table:
    """Of one segment: its documents, and the token sets that can have partners.

    A token is a shared shingle, with its frequency in front so that tokens sort
    rare-first. Frequencies above 255 count as 255 there; any common order will do.
    Shingles whose first ``bits`` are equal share one frequency, in every document alike.
    """
    schema = pa.schema([
        ("is_set", pa.bool_()), ("doc_id", pa.int64()), ("name", pa.binary()), ("size", pa.int32()),
        ("tokens", pa.binary()), ("unshared", pa.int32()),
    ])
    places, names, hashes, owner = keys[0]
    names, places = np.array(names, object), np.array(places, np.int64)
    sizes = np.bincount(owner, minlength=len(names))
    docs = pa.Table.from_arrays(
        [
            pa.array(np.zeros(len(places), bool)), pa.array(ids, pa.int64()),
            pa.array(names[places], pa.binary()), pa.array(sizes[places].astype(np.int32)),
            pa.nulls(len(places), pa.binary()), pa.nulls(len(places), pa.int32()),
        ],
        schema=schema,
    )
    frequency = totals[1][np.searchsorted(keys[1][0], first_bits(hashes, bits))]
    shared = frequency > 1
    tokens = (np.minimum(frequency, np.uint64(255)) << np.uint64(56)) | (hashes & np.uint64((1 << 56) - 1))
    owner, tokens = owner[shared], tokens[shared]
    counts = np.bincount(owner, minlength=len(sizes))
    unshared = sizes - counts
    able = (counts > 0) & (unshared < prefix_length(sizes, percent))
    owner, tokens = owner[able[owner]], tokens[able[owner]]
    order = np.argsort(tokens, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    found = np.flatnonzero(able)
    sets = pa.Table.from_arrays(
        [
            pa.array(np.ones(len(found), bool)), pa.nulls(len(found), pa.int64()),
            pa.array(names[found], pa.binary()), pa.array(sizes[found].astype(np.int32)),
            binary_column(tokens[order], counts[found]), pa.array(unshared[found].astype(np.int32)),
        ],
        schema=schema,
    )
    return pa.concat_tables([docs, sets])


def read_tokens(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate((x, y))
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def least_hashes(batches: Iterator[pa.RecordBatch], turns: int) -> Iterator[pa.RecordBatch]:
    """Each set under its smallest token by hash, for one hash function."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (turns + 1)) % (1 << 64))
    for batch in batches:
        least = [mixed(read_tokens(x.as_py()) ^ salt).min() for x in batch.column("tokens")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(least, np.uint64).astype(np.int64)), *batch.columns],
            names=["least", *batch.schema.names],
        )


def link_leaders(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Verified links to the first similar leader of a group; rows come in group order."""
    group, leaders = None, []
    for batch in batches:
        links = []
        for least, name, size, data in zip(*(batch.column(c).to_pylist() for c in ("least", "name", "size", "tokens"))):
            if least != group:
                group, leaders = least, []
            tokens = read_tokens(data)
            for other, other_size, other_tokens in leaders:
                need = least_overlap(size, other_size, percent)
                if min(len(tokens), len(other_tokens)) >= need and overlap(tokens, other_tokens) >= need:
                    links.append((name, other))
                    break
            else:
                if len(leaders) < LEADERS:
                    leaders.append((name, size, tokens))
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array([x[0] for x in links], pa.binary()), "b": pa.array([x[1] for x in links], pa.binary())}
        )


def postings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A row for each shared token in a set's prefix, with its place there."""
    for batch in batches:
        names, sizes, data, unshared = (
            batch.column(c).to_pylist() for c in ("name", "size", "tokens", "unshared"))
        token, owner, place = [], [], []
        for i, blob in enumerate(data):
            own = read_tokens(blob)
            n = prefix_length(sizes[i], percent) - unshared[i]
            token.append(own[:n])
            owner.append(np.full(len(own[:n]), i))
            place.append(np.arange(len(own[:n])) + unshared[i])
        if not data:
            continue
        at = pa.array(np.concatenate(owner))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(token).astype(np.int64)),
                pa.array(names, pa.binary()).take(at), pa.array(sizes, pa.int32()).take(at),
                pa.array(np.concatenate(place).astype(np.int32)),
            ],
            names=["token", "name", "size", "place"],
        )


def token_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many tokens of each set lie in each cell of the token space, for the suffix filter."""
    for batch in batches:
        cells = []
        for blob in batch.column("tokens").to_pylist():
            own = mixed(read_tokens(blob)) % np.uint64(SUFFIX_CELLS)
            found = np.bincount(own.astype(np.int64), minlength=SUFFIX_CELLS)
            cells.append(found.astype(np.int8) if found.max() < 128 else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("name"), pa.array(cells, pa.list_(pa.int8()))], names=["name", "cells"]
        )


def verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, sa, sb, ta, tb = (
            batch.column(c).to_pylist()
            for c in ("a", "b", "size_a", "size_b", "tokens_a", "tokens_b"))
        good = [
            overlap(read_tokens(x), read_tokens(y)) >= least_overlap(n, m, percent)
            for x, y, n, m in zip(ta, tb, sa, sb)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b")], names=["a", "b"]
        ).filter(pa.array(good, pa.bool_()))


def open_postings(posted: DataFrame) -> DataFrame:
    """Postings of the tokens that still meet several components, with the token's largest one."""
    sizes = posted.groupBy("token", "root").agg(F.count("*").alias("n"))
    largest = (
        sizes.groupBy("token")
        .agg(F.max(F.struct("n", "root"))["root"].alias("largest"), F.count("*").alias("roots"))
        .filter("roots > 1")
        .drop("roots")
    )
    return posted.join(largest, "token")


def prefix_pairs(meeting: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets in different components that pass all filters, each once.

    ``meeting`` holds open postings, ``cells`` those of each set. Of a token's sets, the ones outside its largest
    component are joined with all, so a component of any size makes no pairs of its own.
    """
    # Two sets in different components share open tokens only, so these tell the first one.
    in_order = meeting.groupBy("name").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "token"))), lambda x: x["token"]).alias("open")
    )
    open_tokens = meeting.join(in_order.join(cells, "name"), "name")
    x = open_tokens.filter("root <> largest").drop("largest").alias("x")
    y = open_tokens.alias("y")

    def col(name: str) -> Column:
        return F.col(name)

    small, large = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    need = F.ceil(percent * (col("x.size") + col("y.size")) / F.lit(100 + percent))
    # At the first token that two sets share, no more can follow than the rest of either.
    # Later shared tokens need not pass: the first one does if the pair is similar.
    after = F.least(col("x.size") - col("x.place"), col("y.size") - col("y.place"))
    # Suffix filter: sets share in each cell of the token space no more than the smaller has.
    # Sets too large for cells of one byte go without it.
    by_cell = F.aggregate(
        F.zip_with("x.cells", "y.cells", lambda p, q: F.least(p, q)), F.lit(0), lambda s, v: s + v.cast("int")
    )
    once = (col("y.root") == col("y.largest")) | (col("x.name") < col("y.name"))
    return (
        x.join(
            y,
            (col("x.token") == col("y.token"))
            & (col("x.root") != col("y.root"))
            & once
            & (100 * small >= percent * large)
            & (after >= need)
            & (F.coalesce(by_cell, need) >= need)
            & (F.element_at(F.array_intersect("x.open", "y.open"), 1) == col("x.token")),
        )
        .select(F.least("x.name", "y.name").alias("a"), F.greatest("x.name", "y.name").alias("b"))
    )


def one_a_root(meeting: DataFrame) -> DataFrame:
    """Of the open postings of a token, that of the least set of each component.

    A component is named by its least set, which keeps all its postings. Others keep some, so
    their pairs may be missed here.
    """
    least = meeting.groupBy("token", "root").agg(F.min("name").alias("name"))
    return meeting.join(least, ["token", "root", "name"], "left_semi")


def joined_roots(pairs: DataFrame, sets: DataFrame, root_of: DataFrame, percent: int) -> DataFrame:
    """(root, top): components of components, by those of the pairs that are similar.

    At most one link for each two components goes on.
    """
    # Tokens are wide, so only those of sets in pairs travel. Written, the names have a size: if
    # it is small they are broadcast, and the other sets stay where they are.
    names = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    wanted = staged(sets.join(staged(names, "names"), "name", "left_semi"), "wanted")
    left = wanted.select(F.col("name").alias("a"), F.col("size").alias("size_a"), F.col("tokens").alias("tokens_a"))
    right = wanted.select(F.col("name").alias("b"), F.col("size").alias("size_b"), F.col("tokens").alias("tokens_b"))
    good = pairs.join(left, "a").join(right, "b").mapInArrow(partial(verify, percent=percent), "a binary, b binary")
    links = staged(
        good.join(root_of.select(F.col("name").alias("a"), F.col("root").alias("root_a")), "a")
        .join(root_of.select(F.col("name").alias("b"), F.col("root").alias("root_b")), "b")
        .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        .distinct(),
        "links",
    )
    return components(links).select(F.col("node").alias("root"), F.col("root").alias("top"))


def under_tops(rows: DataFrame, above: DataFrame) -> DataFrame:
    """``rows`` with each root replaced by the one above it."""
    kept = [c for c in rows.columns if c != "root"]
    return rows.join(above, "root", "left").select(*kept, F.coalesce("top", "root").alias("root"))


def similar_sets(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(documents, roots): each document's set name and size; the component of linked sets."""
    chars = text_chars(docs)
    bits = frequency_bits(chars)

    def use(number, ids, texts, keys, totals) -> pa.Table:
        return make_sets(ids, keys, totals, percent, bits)

    kept = staged(
        with_counts(docs, space_words, shingle_frequencies(words, bits), use, KEPT, chars, bits), "shingles"
    )
    listed = kept.filter("not is_set").select("doc_id", "name", "size")
    sets = staged(
        kept.filter("is_set").select("name", "size", "tokens", "unshared").dropDuplicates(["name"]),
        "sets",
    )
    links = None
    for turn in range(2):
        grouped = (
            sets.select("name", "size", "tokens")
            .mapInArrow(partial(least_hashes, turns=turn), "least long, name binary, size int, tokens binary")
            .repartitionByRange("least", "size", "name")
            .sortWithinPartitions("least", "size", "name")
        )
        found = grouped.mapInArrow(partial(link_leaders, percent=percent), "a binary, b binary")
        links = found if links is None else links.unionByName(found)
    links = staged(links, "links")
    roots = components(links)
    # Roots are joined to names and postings; the tokens themselves need not travel for them.
    names = sets.select("name")
    root_of = staged(
        names.join(roots, names["name"] == roots["node"], "left").select("name", F.coalesce("root", "name").alias("root")),
        "roots",
    )
    posted = sets.select("name", "size", "tokens", "unshared").mapInArrow(
        partial(postings, percent=percent), "token long, name binary, size int, place int"
    )
    posted = staged(posted.join(root_of, "name"), "postings")
    cells = staged(
        sets.select("name", "tokens").mapInArrow(token_cells, "name binary, cells array<tinyint>"), "cells"
    )
    meeting = staged(open_postings(posted), "postings")
    # Two large components would make a pair of each two of their sets. So one set of each for
    # a token is compared first, the one it is named by if that has the token; all sets of those
    # still apart follow.
    named = staged(prefix_pairs(one_a_root(meeting), cells, percent), "pairs")
    root_of = staged(under_tops(root_of, joined_roots(named, sets, root_of, percent)), "roots")
    above = root_of.filter("name <> root").select(F.col("name").alias("root"), F.col("root").alias("top"))
    meeting = staged(open_postings(under_tops(meeting.drop("largest"), above)), "postings")
    pairs = staged(prefix_pairs(meeting, cells, percent), "pairs")
    tops = under_tops(root_of, joined_roots(pairs, sets, root_of, percent))
    return listed, tops.select(F.col("name").alias("node"), "root")


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when the Jaccard similarity of their sets of ``words``-word shingles is
    at least ``percent`` / 100; a component's id is its smallest document id. The input
    must be a stored table.

    A text of fewer words is one shingle. Null, empty and blank texts have no shingles and
    stand alone, with their own id. Null ids are never a component's id unless all of its
    ids are null. Repeated rows stay and share a component. An empty table gives no rows.
    Other columns are ignored.
    """
    listed, roots = similar_sets(chosen(docs, doc_id=id_col, text=text_col), words, percent)
    least = listed.groupBy("name").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, least["name"] == roots["node"], "left").select(
        "name", "least", F.coalesce("root", "name").alias("root")
    )
    found = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(found, "root").select("name", "component_id")
    return listed.join(named, "name").select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
