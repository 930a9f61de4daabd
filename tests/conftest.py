from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from chartlake.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        8,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            # Plans are compared as text, whatever the length of the temporary path in them.
            "spark.sql.maxMetadataStringLength": "2000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Set session settings for one test."""
    before = {}

    def change(key: str, value) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df, *columns):
    """The rows as a sorted list of tuples, nulls first."""
    chosen = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in chosen.collect()),
        key=lambda r: [(v is not None, str(type(v)), v) for v in map(_orderable, r)],
    )


def _orderable(value):
    return value if isinstance(value, (int, float, str, type(None))) else str(value)


def final_plan(df) -> str:
    """The plan after run-time planning; runs ``df``."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
