"""The operators on small tables: odd rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import odd_rows, prose, stored  # noqa: F401
from pyspark.sql import functions as F

from chartlake.llm.decontamination import decontaminate
from chartlake.llm.exact_dedup import directory, exact_dedup
from chartlake.llm.html import Alignment, extract, extract_group, parse
from chartlake.llm.licenses import document_licenses, scan
from chartlake.llm.lm import lm_scores
from chartlake.llm.mixing import mix, mixed_sizes
from chartlake.llm.ngram_join import ngram_join
from chartlake.llm import quality
from chartlake.llm.quality import classify, reject_poor
from chartlake.llm.repeats import repeated_passages
from chartlake.llm.sharding import cut_keys, greedy, shard_documents, smallest_capacity


def lists(df, *columns):
    return Counter(tuple(map(str, r)) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def odd(stored):
    return stored(odd_rows())


@pytest.fixture(scope="module")
def empty(stored):
    return stored([])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, 1, None), (10, 0, 0), (7, None, 0), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [("x", "one"), ("y", prose(1, 120).split(" ", 5)[5]), ("z", None), (None, "w1"), ("e", "")]
    return spark.createDataFrame(rows, "item_id string, text string")


def operators(labels, items):
    return {
        "shard": shard_documents, "mix": mixed_sizes, "license": document_licenses,
        "repeats": repeated_passages, "lm": lm_scores, "join": ngram_join, "exact": exact_dedup,
        "quality": lambda d: classify(d, labels), "decontaminate": lambda d: decontaminate(d, items),
    }


NAMES = ["shard", "mix", "license", "repeats", "lm", "join", "exact", "quality", "decontaminate"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_clashing_columns(odd, labels, items, name, stored, spark, tmp_path):
    operator = operators(labels, items)[name]
    found = operator(odd)
    rows = found.collect()
    if name != "repeats":
        assert len(rows) == len(odd_rows())
        assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows())
    clashing = odd.withColumns({
        c: F.lit("x") for c in ("size", "key", "segment", "Text2", "score", "root", "name", "_row", "label", "bucket", "c0")
    })
    clashing.write.parquet(str(tmp_path / "d"))
    again = operator(spark.read.parquet(str(tmp_path / "d")))
    assert lists(again, *found.columns) == Counter(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(empty, labels, items, name):
    assert operators(labels, items)[name](empty).collect() == []


def test_exact_dedup_against_brute_force(odd):
    groups = defaultdict(list)
    for i, t, _ in odd_rows():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    want = Counter()
    for norm, members in groups.items():
        keep = min(members)[3]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for rank, m in enumerate(sorted(members)):
            want[tuple(map(str, (m[3], keep, len(members), rank == 0, sha)))] += 1
    assert lists(exact_dedup(odd), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    slots, depth = directory(keys, capacity=100)
    counts = keys.groupBy(F.call_function("shiftrightunsigned", "key", F.lit(64 - depth)).alias("slot")).count()
    joined = counts.join(slots, "slot")
    assert joined.agg(F.sum("count")).first()[0] == 3000
    assert joined.groupBy("bucket", "depth").agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] <= 100


@pytest.mark.parametrize("hot", [1, 900])
def test_cuts_are_those_of_the_smallest_capacity(spark, monkeypatch, hot):
    from chartlake.llm import sharding

    monkeypatch.setattr(sharding, "FIRST_BITS", 4)
    monkeypatch.setattr(sharding, "ROUND_BLOCKS", 64)
    rows = sorted((hash((n, "k")) % (1 << 60), 1 + n * 7919 % 100) for n in range(400))
    rows[130] = (rows[130][0], hot)
    ends, total = [], 0
    for _, size in rows:
        total += size
        ends.append(total)
    want = smallest_capacity(ends, 16, max(r[1] for r in rows))
    cuts, found = cut_keys(spark.createDataFrame(rows, "key long, bytes long"), 16)
    assert found == want
    assert cuts == [rows[i][0] for i in greedy(ends, 16, want)[:-1]]
    assert len(greedy(ends, 16, want - 1)) > 16 or want == max(r[1] for r in rows)


def test_shards_are_whole_gapless_and_atomic(odd):
    rows = shard_documents(odd, shards=4).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    texts = {(i, t) for i, t, _ in odd_rows() if t is not None}
    sizes = Counter((i, 1 + len(t.encode()), zlib.crc32(t.encode())) for i, t in texts)
    assert set(sizes) == {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows if r["text_crc32"] is not None}
    of = defaultdict(set)
    for r in rows:
        of[r["text_crc32"]].add(r["shard"])
    assert all(len(v) == 1 for v in of.values())


def test_mix_takes_the_targets_and_no_block_more_than_twice(stored):
    docs = stored([(i, prose(i, 40 + i % 90), f"s{i % 5 if i > 900 else 0}") for i in range(1200)])
    rows = mixed_sizes(docs).collect()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1
    _, slots = mix(docs, shard_blocks=64)
    times = slots.groupBy("source", "block").count()
    assert times.agg(F.max("count")).first()[0] <= 2
    assert slots.groupBy("source", "slot").count().filter("count > 1").isEmpty()
    assert slots.groupBy("shard").count().agg(F.max("count")).first()[0] <= 64


def test_near_copies_of_a_large_group_link_without_pairs(stored):
    base = prose(5, 300).split(" ")
    rows = [(0, prose(9, 300), "a")]
    for i in range(1, 150):
        words = list(base)
        words[(i * 37) % 300] = f"new{i}"
        rows.append((i, " ".join(words), "a"))
    found = {r["doc_id"]: r["component_id"] for r in ngram_join(stored(rows)).collect()}
    assert found == {0: 0} | {i: 1 for i in range(1, 150)}


def test_decontaminate_finds_planted_windows(stored, spark):
    item = prose(3, 14)
    docs = stored([
        (1, prose(4, 50) + " " + item.upper() + " " + prose(6, 5), "a"), (2, prose(4, 50), "a"),
        (3, " ".join(item.split(" ")[:9]), "a"), (4, "three-WORD  item!", "a"),
    ])
    bench = spark.createDataFrame([("i1", item), ("i2", "three word item"), ("i3", None)], "item_id string, text string")
    rows = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate(docs, bench).collect()}
    assert rows == {1: (69, 14, ["i1"]), 2: (50, 0, []), 3: (9, 0, []), 4: (3, 3, ["i2"])}
    near = stored([(1, " ".join(w + (" filler" if i == 4 else "") for i, w in enumerate(item.split(" ")[:10])), "a")])
    assert not decontaminate(near, bench).first()["contaminated"]
    assert decontaminate(near, bench, slack=1).first()["contaminated"]


def test_repeats_start_at_fifty_words(stored):
    passage = prose(8, 50)
    docs = stored([
        (1, prose(11, 30) + " " + passage + " " + prose(12, 40), "a"), (2, prose(13, 70) + " " + passage, "a"),
        (3, " ".join(passage.split(" ")[:49]) + " " + prose(14, 60), "a"), (4, prose(15, 200), "a"),
    ])
    assert sorted(map(tuple, repeated_passages(docs).collect())) == [(1, 30, 50), (2, 70, 50)]


def test_lm_backs_off(stored):
    docs = stored([(1, "a b c", "s"), (2, "a b d", "s")])
    rows = {r["doc_id"]: r["log_score"] for r in lm_scores(docs).collect()}
    # Against the other document: a 1/3; b after a 1/1; the last word is unseen there.
    import math

    want = math.log(1 / 3) + math.log(1.0) + math.log(0.4 * 0.5 / 3)
    assert rows[1] == pytest.approx(want) and rows[2] == pytest.approx(want)


def test_classifier_learns_and_keeps_columns(stored, spark):
    rows = [(i, prose(i, 80) if i % 3 else " ".join(f"{w}$$$" for w in prose(i, 80).split()), "a") for i in range(300)]
    docs = stored(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300, 2)], "doc_id long, quality int")
    found = classify(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r["held_out"]]
    assert held and all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held)
    kept = reject_poor(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in found)


def test_html_leaves_the_article(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav>"
        "<header>Top</header><div class='cookie-notice'>Accept</div><script>var a='</p>';</script>"
        "<article><h1>A &amp; B</h1><p>One <b>two</b>\n three&nbsp;four<p>Five<br>six<aside>Side</aside>"
        "<form><input>Name</form><section class='comments'><p>Me too</section></article>"
        "<aside>Other</aside><footer>&copy; x</footer>"
    )
    rows = [(1, "http://h.example/a", page), (2, "http://h.example/b", None), (3, None, ""), (None, "nonsense", "<p>only</p>"),
            (1, "http://h.example/a", page), (4, "http://h.example/deep", "<div>" * 3000 + "deep")]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    text = "A & B\nOne two three four\nFive six"
    assert Counter((r["page_id"], r["text"], r["n_chars"]) for r in found.collect()) == Counter(
        [(1, text, len(text))] * 2 + [(2, "", 0), (3, "", 0), (None, "only", 4), (4, "deep", 4)]
    )
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_html_learns_a_template_without_semantic_tags(spark):
    rows = [
        (i, f"http://h.example/{i}", f"<div><div>Site name</div><div><a href=/>Link {i}</a></div><div>{prose(i, 30)}</div><div>All rights</div></div>")
        for i in range(20)
    ]
    found = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: prose(i, 30) for i in range(20)}


def test_licences_are_inherited_from_the_nearest_directory(spark):
    rows = [
        ("r/LICENSE", "Released under the MIT License."), ("r/a/x", "code"), ("r/a/b/LICENSE", "Licensed under CC BY-NC 4.0."),
        ("r/a/b/c/y", None), ("r/a/z", "// Licensed under the Apache License, Version 2.0.\ncode"), ("q/w", "license"), (None, ""),
    ]
    files = spark.createDataFrame(rows, "path string, text string")
    found = scan(files, "path", "text", F.col("_path").endswith("LICENSE"))
    got = {r["path"]: (r["licence"], r["how"], r["from_dir"]) for r in found.collect()}
    assert got == {
        "r/LICENSE": ("MIT", "notice", None), "r/a/x": ("MIT", "inherited", "r"),
        "r/a/b/LICENSE": ("CC-BY-NC-4.0", "notice", None), "r/a/b/c/y": ("CC-BY-NC-4.0", "inherited", "r/a/b"),
        "r/a/z": ("Apache-2.0", "notice", None), "q/w": (None, None, None), None: (None, None, None),
    }


@pytest.mark.parametrize("body", ["<body class='has-sidebar'>", "<body class='no-sidebar'>", "<body class='widget'>"])
def test_html_marks_are_whole_names_of_the_element_itself(spark, body):
    def page(i):
        return (
            f"<html class='promo'>{body}<nav>Menu {i}</nav><div class='share-price'><p>Price {i}</p></div><div>{prose(i, 30)}</div>"
            f"<article><p><a href='/'>Teaser {i}</a></p></article><div class='big ad'>Buy {i}</div><div>All rights</div></body></html>"
        )

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)]
    found = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"Price {i}\n{prose(i, 30)}\nTeaser {i}" for i in range(8)}


def test_html_keeps_content_that_is_only_in_marked_elements(spark):
    rows = [
        (i, f"http://h.example/{i}", f"<div>Site name</div><form><div class='related'><p>{prose(i, 30)}</p></div></form><div>All rights</div><div>End</div>")
        for i in range(8)
    ]
    found = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(prose(i, 30) in text for i, text in found.items()) and len(found) == 8


def test_html_aligns_long_lists_of_siblings():
    def page(i):
        blocks = []
        for k in range(70):
            blocks += [f"<p>{prose(1000 * i + 10 * k + j, 12)}</p>" for j in range(1 + (i * 7 + k * 3) % 5 % 2)]
            blocks.append(f"<div class=c{k}><h4>Notice {k}</h4><p>Terms {k}</p><p>Rules {k}</p></div>")
        return "".join([*(f"<h2>Top {i}</h2>" for _ in range(i % 2)), *blocks, *(f"<h3>End {i}</h3>" for _ in range(i % 3))])

    pages = [page(i) for i in range(10)]
    for html, text in zip(pages, extract_group(pages)):
        content = re.sub(r"<div.*?</div>", "", html)
        assert text == "\n".join(re.findall(r">([^<]+)<", content))


def test_html_alignment_is_the_best_one():
    def best(a, b):
        if a.label != b.label:
            return 0
        table = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, x in enumerate(a.kids, 1):
            for j, y in enumerate(b.kids, 1):
                table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + best(x, y))
        return 1 + table[-1][-1]

    for seed in range(60):
        trees = []
        for part in (0, 1):
            draw = [int(w[1:]) for w in prose(2 * seed + part, 30, 9).split()]
            trees.append(parse("".join(f"<{('p', 'div', '/div', 'h2', 'ul', '/ul', 'li', 'div', '/p')[w]}>t{w}" for w in draw)))
        alignment = Alignment()
        for tree in trees:
            alignment.add(tree)
        assert alignment.score(trees[0].shape, trees[1].shape) == best(*trees)
        pairs = alignment.pairs(*trees)
        assert len({id(a) for a, _ in pairs}) == len({id(b) for _, b in pairs}) == len(pairs)


def test_pipeline_decides_by_row(stored, spark, tmp_path):
    import corpus_pipeline

    twin, near, leak = prose(81, 120), prose(82, 120), prose(83, 60)
    docs = stored([
        (1, twin, "a"), (1, twin, "a"), (1, twin, "a"), (None, twin, "b"), (None, near, "a"), (None, near + " end", "a"),
        (5, prose(84, 120), "a"), (5, near, "b"), (6, leak, "a"), (6, prose(85, 90), "a"), (None, leak, "b"),
        (None, prose(86, 90), "b"), (7, None, "a"), (None, None, "a"), (None, prose(87, 90), "a"), (None, prose(87, 90), "a"),
    ])
    spark.createDataFrame([("x", leak)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    alone = corpus_pipeline.drop_similar(spark, docs, str(tmp_path))
    assert alone.columns == docs.columns
    got = lists(alone, "doc_id", "text")
    assert got == Counter((str(i), str(t)) for i, t in [
        (1, twin), (5, near), (5, prose(84, 120)), (6, leak), (6, prose(85, 90)),
        (None, prose(86, 90)), (7, None), (None, None), (None, prose(87, 90)),
    ])
    clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert lists(clean, "doc_id", "text") == lists(docs.filter("text is null or text <> '" + leak + "'"), "doc_id", "text")
    assert clean.columns == docs.columns


def test_classifier_learns_from_a_thousand_rows_a_class_sent_small():
    idf = np.ones(quality.FEATURES, np.float32)
    texts = [prose(i, 100) for i in range(4)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "label": pa.array([0, 1, 0, 1])})
    (sent,) = quality.sample_features(idf)(iter([batch]))
    raw = quality.features(texts, idf)
    assert quality.SAMPLE == 1000
    for own, data in zip(raw, sent.column("features").to_pylist()):
        assert len(data) < own.nbytes / 4 and zlib.decompress(data) == own.tobytes()


def test_classifier_chooses_among_texts_of_one_id_by_hash(stored, spark):
    rows = [(i // 2, prose(i, 60 + i % 7) if i % 4 < 2 else prose(i, 60).replace("w", "$"), "a") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")

    def scores(own, files):
        return {(r["doc_id"], round(r["score"], 9)) for r in classify(stored(own, files), labels, sample=20).collect()}

    assert scores(rows, 1) == scores(rows[::-1], 5)


def test_votes_are_those_of_the_nearest_neighbours():
    """Blocked cosine products against every vector one by one."""
    rng = np.random.default_rng(11)
    idf = np.ones(quality.FEATURES, np.float32)
    texts = [prose(i, 5 + i) for i in range(70)] + [None, ""]
    matrix = quality.features(texts[:40], idf)
    axes = np.linalg.qr(rng.normal(size=(matrix.shape[1], 24)))[0].astype(np.float32)
    vectors, labels = quality.projected(matrix, axes), (np.arange(40) % 3 == 0).astype(np.float32)
    voters = {"idf": idf, "axes": axes, "vectors": vectors, "labels": labels, "prior": 0.5}

    class Broadcast:
        value = voters

    batch = pa.RecordBatch.from_pydict({"_text": pa.array(texts), "doc_id": pa.array(range(len(texts)))})
    (out,) = quality.scorer(Broadcast, 7)(iter([batch]))
    for text, score in zip(texts, out.column("_score").to_pylist()):
        own = quality.projected(quality.features([text], idf), axes)[0]
        order = sorted(range(40), key=lambda j: -float(own @ vectors[j]))[:7]
        weights = [max(float(own @ vectors[j]), 0) ** 4 + 1e-6 for j in order]
        assert score == pytest.approx(sum(w * labels[j] for w, j in zip(weights, order)) / sum(weights), rel=1e-4)


def test_shards_against_brute_force(stored):
    """The smallest capacity is found by trying every one, over the groups in their order."""
    rows = [(i, prose(i % 90, 1 + i * 13 % 40), "a") for i in range(300)]
    found = shard_documents(stored(rows), shards=5).collect()
    sizes, shard_of = Counter(), {}
    for r in found:
        sizes[r["text_crc32"]] += r["size"]
        shard_of[r["text_crc32"]] = r["shard"]
    # Contiguous in the order of shards and slots, every group whole.
    order = list(dict.fromkeys(r["text_crc32"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))))
    groups = [sizes[k] for k in order]

    def shards_needed(capacity):
        count, filled = 1, 0
        for g in groups:
            if filled + g > capacity:
                count, filled = count + 1, 0
            filled += g
        return count

    least = next(c for c in range(max(groups), sum(groups) + 1) if shards_needed(c) <= 5)
    fill = Counter()
    for k in order:
        fill[shard_of[k]] += sizes[k]
    assert max(fill.values()) == least


def test_short_sources_meet_their_targets(stored):
    for words in (400, 50, 1):
        docs = stored([(10 * words + 3 * i + s, prose(i * 3 + s, 1 if words == 1 else words // 5), f"s{s}") for s in range(3) for i in range(5 if words > 1 else 1)])
        taken, target = Counter(), {}
        for r in mixed_sizes(docs).collect():
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
            assert r["taken"] == sum(x["words"] for x in r["shards"]) <= 2 * r["size"]
        assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], 0.5) for s in target)


def test_pipeline_stages_with_clashing_columns_and_empty_tables(stored, spark, tmp_path):
    import corpus_pipeline

    rows = [(i, prose(i, 60), f"s{i % 3}") for i in range(30)] + [(100 + i, prose(i, 60), "s0") for i in range(5)] + odd_rows()
    plain = stored(rows)
    names = ["_row", "_ROW", "_times", "_copy", "row_key", "times", "copy", "file", "place", "start", "c0", "_metadata", "id", "name"]
    wide = plain.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names if n != "_ROW"})
    wide.write.parquet(str(tmp_path / "wide"))
    sf = str(tmp_path)
    spark.createDataFrame([("x", prose(7, 60))], "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(str(tmp_path / "wide"))
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, sf), stage(spark, plain, sf)
        if name != "sharding":
            assert got.columns == docs.columns
            assert got.filter("_row is not null and _row <> concat('_row', doc_id)").isEmpty()
        assert lists(got, "doc_id") == lists(want, "doc_id")
        assert stage(spark, stored([]), sf).collect() == []


def test_mix_stage_decides_by_row(stored, spark, tmp_path):
    import corpus_pipeline

    docs = stored([(None if i % 2 else 1, prose(i, 20 + i % 30), f"s{i % 3}") for i in range(600)])
    sizes, taken = Counter(), Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(r["text"].split())
    for r in corpus_pipeline.mix_sources(spark, docs, str(tmp_path)).collect():
        taken[r["source"]] += len(r["text"].split())
    target = {r["source"]: r["target"] for r in mixed_sizes(docs).collect()}
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)


def test_html_finds_a_slot_that_its_first_model_lacks():
    def page(i):
        extra = "".join(f"<p>{prose(50 * i + k, 12)}</p>" for k in range(9 if i == 4 else 5))
        footer = "<h4>Unmarked closing words of the site</h4>" if i != 4 else ""
        return f"<div>{extra}</div>{footer}"

    pages = [page(i) for i in range(12)]
    for html, text in zip(pages, extract_group(pages)):
        assert text == "\n".join(re.findall(r"<p>([^<]+)", html))


@pytest.mark.parametrize("n", [2, 4])
def test_html_induces_from_few_pages(n):
    pages = [f"<div>Site name</div><div>{prose(i, 30)}</div><div>All rights kept</div>" for i in range(n)]
    assert extract_group(pages) == [prose(i, 30) for i in range(n)]
    inside = [f"<article><p>Same opening</p><p>{prose(i, 30)}</p></article>" for i in range(n)]
    assert extract_group(inside) == [f"Same opening\n{prose(i, 30)}" for i in range(n)]


def test_html_of_more_than_two_hundred_blocks():
    pages = ["".join(f"<p>{prose(1000 * i + k, 6)}</p>" for k in range(210 + i % 3)) + "<div>Closing</div>" for i in range(6)]
    for html, text in zip(pages, extract_group(pages)):
        assert text == "\n".join(re.findall(r"<p>([^<]+)", html))


def test_decontaminate_counts_null_and_empty_item_ids_apart(stored, spark, monkeypatch):
    from chartlake.llm import decontamination

    bench = spark.createDataFrame([(None, "one two"), ("", "two three"), ("x", "four")], "item_id string, text string")
    docs = stored([(1, "One two three", "a"), (2, "four", "a"), (3, "five", "a"), (4, None, "a")])

    def found():
        return {r["doc_id"]: (r["n_items"], r["items"], r["n_hit"]) for r in decontaminate(docs, bench).collect()}

    want = {1: (2, ["", ""], 3), 2: (1, ["x"], 1), 3: (0, [], 0), 4: (0, [], 0)}
    assert found() == want
    monkeypatch.setattr(decontamination, "MOST_TERMS", 2)  # more terms are asked: all are indexed
    assert found() == want
    with pytest.raises(ValueError):
        decontaminate(docs, bench, slack=63)
    assert decontaminate(docs, bench, slack=60).count() == 4
