"""The registered queries: against their SQL, and the pipeline against its parts."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pytest
from conftest import SF_DIR
from parity import compare, connect

import __spark_entry__ as contract
import corpus_pipeline
from chartlake.llm.queries import MORE_ORACLES, ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_all_operators_and_the_pipeline_are_registered():
    numbers = Counter(re.match(r"op(\d+)_", name)[1] for name in QUERIES)
    assert numbers == Counter(map(str, range(1, 14)))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, duck, name):
    _, wrong = compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    assert wrong == ""


def test_shards_of_the_documents(spark):
    rows = QUERIES["op1_sharding"](spark, SF_DIR).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert set(sizes) <= set(range(16)) and {r["law"] for r in rows} == {"bytes"}
    # Greedy cuts at the smallest capacity: no shard holds more than it.
    assert max(sizes.values()) < 1.25 * sum(sizes.values()) / 16


def test_main_texts_of_the_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in QUERIES["op3_html_extraction"](spark, SF_DIR).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_licences_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    notice = {
        "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    want = {}
    for d in docs:
        own = sorted(notice[x] for x in d["text"].split("\n") if x in notice)
        if own:
            want[d["doc_id"]] = own[0]
    rows = QUERIES["op4_license_scan"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    assert {r["doc_id"]: r["licence"] for r in rows if r["how"] == "notice"} == want
    given = {}
    for d in docs:
        last = [x for x in d["text"].split("\n") if re.search("[A-Za-z0-9]", x)][-1]
        if last in notice:
            given.setdefault((d["source"], d["lang"]), []).append(notice[last])
    of = {d["doc_id"]: (d["source"], d["lang"]) for d in docs}
    for r in rows:
        if r["how"] != "notice":
            assert r["licence"] == min(given.get(of[r["doc_id"]], [None]))


def test_quality_on_the_held_out_fold(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op9_quality"](spark, SF_DIR).collect() if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in rows)
    assert right >= 0.85 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_pipeline_stages(spark, tmp_path):
    """Each stage against the decisions of its operator on the same input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = (Counter(r["doc_id"] for r in before.collect()), Counter(r["doc_id"] for r in docs.collect()))
        if name != "sharding":
            assert docs.columns == columns
    from chartlake.llm.decontamination import decontaminate

    assert all(set(after) <= set(start) for start, after in kept.values())
    assert kept["sharding"][0] == kept["sharding"][1]
    assert set(kept["mixing"][1].values()) <= {1, 2}
    clean = spark.read.parquet(str(tmp_path / "decontamination"))
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert decontaminate(clean, bench).filter("contaminated").isEmpty()
    shingles = {}
    for r in spark.read.parquet(str(tmp_path / "near_duplicates")).collect():
        words = r["text"].lower().split()
        shingles[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    ids = sorted(shingles)
    assert not any(
        len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])
        for i, a in enumerate(ids) for b in ids[:i]
    )
    assert corpus_pipeline.run(spark, SF_DIR).count() == sum(kept["sharding"][1].values())


@pytest.mark.parametrize("name", list(MORE_ORACLES))
def test_further_query(spark, duck, name):
    _, wrong = compare(contract.queries()[name](spark, SF_DIR), duck, MORE_ORACLES[name])
    assert wrong == "" and contract.oracle_sql()[name] == MORE_ORACLES[name]
