"""What the driver holds for the pipeline: few tasks for links, little memory for axes."""

from __future__ import annotations

import os
import random
import subprocess
import sys
import textwrap

import numpy as np

from chartlake.llm import components as linked
from chartlake.llm.quality import leading

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def smallest_reachable(links: list[tuple[int, int]]) -> dict[int, int]:
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {x: top(x) for x in list(root)}


def test_links_are_settled_in_few_scans_and_shuffles(spark, monkeypatch):
    """Before, a round and the look at its result had 19 scans and 12 shuffles."""
    draw = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1080)]
    hub = [(5000, i) for i in range(2000, 2200)] + [(1, i) for i in range(3000, 3200)]
    some = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)]
    links = [x for x in chain + hub + some + some[:50] if x[0] != x[1]]
    plans, staged, unsettled = [], linked.staged, getattr(linked, "unsettled", None)

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    def open_nodes(edges):
        out = unsettled(edges)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(linked, "staged", watched)
    if unsettled:
        monkeypatch.setattr(linked, "unsettled", open_nodes)
    found = linked.components(spark.createDataFrame([*links, (7, 7)], "a long, b long")).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["root"] for r in found} == smallest_reachable(links)
    rounds = plans[1:3]
    assert sum(p.count("FileScan") for p in rounds) <= 6
    assert sum(p.count("Exchange hashpartitioning") for p in rounds) <= 8


def test_leading_vectors_are_those_of_the_full_decomposition():
    draw = np.random.default_rng(1)
    rows = draw.standard_normal((700, 900)) * np.linspace(3, 0.1, 900) ** 2
    for gram in (rows @ rows.T, rows[:40] @ rows[:40].T, np.zeros((600, 600))):
        values, vectors = leading(gram, 16)
        wanted, full = np.linalg.eigh(gram)
        assert np.allclose(values, wanted[::-1][:16], rtol=1e-8, atol=1e-8)
        if wanted[-1] > 0:
            same = np.abs((vectors * full[:, ::-1][:, :16]).sum(axis=0))
            assert same.min() > 1 - 1e-6


def test_matrices_that_do_not_settle_are_decomposed_in_full():
    values, vectors = leading(np.diag(np.ones(600)) + np.diag(np.linspace(0, 1e-9, 600)), 16)
    assert np.allclose(values, 1) and np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-8)


def test_axes_of_a_full_sample_take_little_memory():
    """Before, the decomposition for a sample of 2,000 rows took 187 MB beside the sample."""
    code = """
        import resource
        import numpy as np
        from chartlake.llm.quality import singular_axes
        draw = np.random.default_rng(0)
        rows = draw.standard_normal((2000, 200), np.float32) * np.linspace(2, 0.2, 200, dtype=np.float32)
        rows = rows @ draw.standard_normal((200, 4101), np.float32)
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        singular_axes(rows, 64)
        print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
    """
    env = os.environ | {"PYTHONPATH": ROOT, "OMP_NUM_THREADS": "1"}
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-2000:]
    assert float(run.stdout.split()[-1]) < 110
