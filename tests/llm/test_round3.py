"""Line dedup, ranked lexical search and hard negatives against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import odd_rows, prose, stored  # noqa: F401
from pyspark.sql import functions as F

from chartlake.llm import lexical, negatives
from chartlake.llm.lexical import Lists, best_positions, lexical_search
from chartlake.llm.lines import drop_repeated_lines
from chartlake.llm.negatives import hard_negatives, hilbert_keys, interval, products

CLASHING = ("size", "key", "line", "gone", "Text2", "TEXT_HASH", "item", "term", "score", "rank", "stripe", "data", "c0")


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --- lines ----------------------------------------------------------------------


def lines_by_hand(rows, least=10, at_least=2):
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    of = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                of[key(line)].add(i)
    keeper = {k: min((i for i in v if i is not None), default=None) for k, v in of.items() if len(v) >= at_least}
    result = Counter()
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if key(x) not in keeper or i == keeper[key(x)]]
        result[i, "\n".join(kept), len(own), len(own) - len(kept)] += 1
    return result


LINES = [
    (3, "Shared line one\nown line of three\n  SHARED LINE ONE \nshort"), (1, "shared line one\n\n\nshort\nother text here"),
    (2, "\tshared line one\x0b"), (2, "\tshared line one\x0b"), (None, "shared line one\nnull line alone"),
    (None, "null line alone\nnull line alone"), (4, None), (5, ""), (6, "\n"), (7, "short\nshort"),
    (8, "ÄÖÜ line with ÉÈ\nend\n"), (9, "äöü line with éè\nend\n"), (10, "ÄÖÜ LINE with ÉÈ"), (11, "123456789"), (12, "123456789"),
    (13, "1234567890"), (14, "1234567890"), (15, "\r\n1234567890 \r\nlast"),
    (16, "\n".join(["shared line one", "only here, " + prose(5, 9)] * 4000)),
]


@pytest.mark.parametrize("odd", [False, True])
def test_lines_against_brute_force(stored, odd):
    rows = [(i, t) for i, t, _ in odd_rows()] if odd else LINES
    docs = stored([(i, t, "s") for i, t in rows])
    found = Counter(map(tuple, drop_repeated_lines(docs).collect()))
    assert found == lines_by_hand(rows)
    assert Counter(map(tuple, drop_repeated_lines(clashing(docs)).collect())) == found


def test_lines_of_other_thresholds(stored):
    docs = stored([(i, t, "s") for i, t in LINES])
    found = Counter(map(tuple, drop_repeated_lines(docs, least_chars=3, at_least=3).collect()))
    assert found == lines_by_hand(LINES, 3, 3)


def test_lines_of_an_empty_table(stored):
    assert drop_repeated_lines(stored([])).collect() == []


def test_a_line_that_fills_a_partition_is_split(stored, setting, spark):
    """A third of all lines are one line; the join splits the partition that it fills."""
    for key, value in {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        setting(key, value)
    docs = stored([(i, "the same line everywhere\n" + prose(i, 5) + "\n" + prose(i + 9000, 5), "s") for i in range(9000)], 8)
    found = drop_repeated_lines(docs)
    assert found.agg(F.sum("n_dropped")).first()[0] >= 8999
    found.collect()
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


# --- search ---------------------------------------------------------------------


def search_by_hand(docs, items, k):
    own = [(i, [low(w) for w in words(t)]) for i, t in docs]
    n_all, total = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    holding = Counter(t for _, w in own for t in set(w))
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= {low(w) for w in words(t)}
    result = []
    for item, terms in asked.items():
        scores = []
        for i, w in own:
            times, s = Counter(w), 0
            for t in terms & set(times):
                m = 100 - 50 + (50 * len(w) * n_all) // total
                s += math.floor(1000 * math.log((2 * n_all + 2) / (2 * holding[t] + 1))) * (
                    (1000000000 * times[t]) // (1000 * times[t] + 20 * m)
                )
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        result += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return Counter(result)


@pytest.fixture(scope="module")
def library():
    rows = [(i, prose(i, 5 + i * 7 % 60, 300)) for i in range(400)]
    return rows + [(900 + i, rows[3][1]) for i in range(30)] + [(3, rows[3][1]), (None, rows[5][1])]


ITEMS = [
    (1, prose(3, 26, 300)), (2, prose(77, 40, 300)), (3, None), (4, ""), (5, "--- !"), (6, "nowhere W1 w1 W2"), (6, "w3, w4"),
    (None, "w5_w6"), (7, "w7"), (8, " ".join(f"w{i}" for i in range(300))),
]


@pytest.mark.parametrize("k", [1, 7, 50])
def test_search_against_brute_force(stored, spark, library, k, monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_WORDS", 2500)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = lexical_search(stored([(i, t, "s") for i, t in library]), items, k=k)
    assert Counter(map(tuple, found.collect())) == search_by_hand(library, ITEMS, k)


def test_search_in_slices_and_with_other_columns(stored, spark, library, tmp_path):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = clashing(stored([(i, t, "s") for i, t in library]))
    docs.write.parquet(str(tmp_path / "d"))
    found = lexical_search(spark.read.parquet(str(tmp_path / "d")), clashing(items), k=5, pairs=100)
    assert Counter(map(tuple, found.collect())) == search_by_hand(library, ITEMS, 5)


def test_search_of_odd_and_empty_tables(stored, spark):
    rows = [(i, t) for i, t, _ in odd_rows()]
    asked = [("a", "one two"), ("b", "ä ß"), ("c", None), ("d", rows[0][1])]
    items = spark.createDataFrame(asked, "item_id string, text string")
    found = lexical_search(stored(odd_rows()), items)
    assert Counter(map(tuple, found.collect())) == search_by_hand(rows, asked, 50)
    assert lexical_search(stored([]), items).collect() == []
    assert lexical_search(stored(odd_rows()), items.limit(0)).collect() == []


def test_best_positions_stop_before_the_end():
    """Reading stops early, and only strictly below the last wanted score."""
    n = 5000
    times = np.ones((2, n), np.int64)
    times[:, :40] = 400 - np.arange(40)
    row = {
        "ids": list(range(n)), "lengths": [500] * n, "terms": [0, 1], "counts": [n, n],
        "docs": np.tile(np.arange(n), 2).astype("<u4").tobytes(), "times": times.ravel().astype("<u4").tobytes(),
    }
    lists = Lists(row, np.array([1000, 1000]), n, 500 * n)
    found, scored = best_positions(lists, [0, 1], 10)
    assert [d for _, d in found] == list(range(10)) and scored < n / 10
    tied = dict(row, times=np.ones(2 * n, "<u4").tobytes())
    found, scored = best_positions(Lists(tied, np.array([1000, 1000]), n, 500 * n), [0, 1], 10)
    assert [d for _, d in found] == list(range(10)) and scored == n


# --- hard negatives ---------------------------------------------------------------


def negatives_by_hand(rows, every=50, positives=5, least=3, lower=50, upper=95):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if i not in kept or label < kept[i][0]:
            kept[i] = (label, q)
    result = set()
    for a, (label, q) in kept.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, w)) for i, (_, w) in kept.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == label][:positives]:
            fit = [i for i in order if kept[i][0] != label and lower * score[p] <= 100 * score[i] <= upper * score[p]]
            result |= {(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit[:least], 1)}
    return result


def vectors(n=600, dims=12, labels=4, seed=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    return [
        (i, [float(np.float32(x)) for x in centres[i % labels] * 0.7 + rng.normal(size=dims)], i % labels) for i in range(n)
    ]


SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [
    (None, [1.0] * 12, 1), (10_001, None, 1), (10_002, [1.0] * 12, None), (10_003, [1.0, None], 2), (10_004, [float("nan")] * 12, 1),
    (10_005, [float("inf")] + [0.0] * 11, 1), (10_050, [], 1), (10_100, [1.0] * 3, 1), (10_150, [2.0] * 20, 2), (10_151, [0.0] * 12, 0),
    (10_152, [1.0] * 12, 3), (10_152, [1.0] * 12, 3), (10_153, [-1.0] * 12, 2), (10_200, [300.0] * 12, 2), (10_201, [290.0] * 12, 2),
]


@pytest.mark.parametrize("stripe", [64, 16_384])
def test_negatives_against_brute_force(spark, stripe, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 32)
    rows = vectors() + [(20_000 + i, vectors()[3][1], i % 3) for i in range(200)] + ODD
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), stripe_rows=stripe)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == negatives_by_hand(rows) and len(got) > 50


def test_negatives_with_other_columns_and_empty_tables(spark):
    rows = vectors(200)
    plain = spark.createDataFrame(rows, SCHEMA)
    want = {tuple(r) for r in hard_negatives(clashing(plain)).collect()}
    assert want == negatives_by_hand(rows)
    assert hard_negatives(plain.limit(0)).collect() == []
    assert hard_negatives(plain.filter("label = 1")).collect() == []
    assert hard_negatives(plain.filter("vec_id % 50 <> 0")).collect() == []


def test_very_large_components_are_exact():
    a, b = np.array([[2.0**40 + 1, 3.0]]), np.array([[2.0**20 + 1, -5.0], [1.0, 2.0]])
    assert products(a, b).tolist() == [[(2**40 + 1) * (2**20 + 1) - 15, 2**40 + 7]]


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2), (16, 1)])
def test_the_curve_visits_neighbours(dims, bits):
    """Every cell once, and one step in one dimension from each cell to the next."""
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_for_every_vector_of_a_block():
    rng = np.random.default_rng(3)
    anchors, block = rng.integers(-99, 99, (20, 6)).astype(float), rng.integers(-50, 70, (40, 6)).astype(float)
    least, most = interval(anchors, block.min(0)[None], block.max(0)[None])
    scores = anchors @ block.T
    assert (scores.min(1) >= least[:, 0]).all() and (scores.max(1) <= most[:, 0]).all()


def test_blocks_out_of_reach_are_not_read():
    """On two far clusters the zone maps spare the blocks that cannot hold a wanted score."""
    rng = np.random.default_rng(5)
    near, far = rng.normal(5, 0.1, (64, 8)), rng.normal(-5, 0.1, (64, 8))

    def block(matrix, first):
        matrix = np.floor(256 * matrix)
        ids, labels = np.arange(first, first + 64), np.zeros(64, np.int32)
        return {
            "n": 64, "label_low": 0, "label_high": 0, "low": matrix.min(0).tolist(), "high": matrix.max(0).tolist(),
            "ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i4").tobytes(), "data": negatives.packed(matrix),
        }

    rows = [block(far, 1000), block(near, 0), block(far, 2000)]
    blocks = {c: [r[c] for r in rows] for c in rows[0]}
    anchors = {
        "vec_id": [0], "label": [0], "data": [negatives.packed(np.floor(256 * near[:1]))], "floor": [None], "ceiling": [None],
    }
    best, read = negatives.read_blocks(blocks, anchors, True, 5)
    assert read == 1 and len(best.id) == 5 and best.id.max() < 64
