"""Run one job: ``python -m chartlake f_ranking --root s3a://bucket/lake``."""

from __future__ import annotations

import argparse
import inspect
from datetime import date

from chartlake.plans.jobs import JOBS
from chartlake.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="chartlake")
    parser.add_argument("job", choices=list(JOBS))
    parser.add_argument("--root", required=True, help="root folder of the lake")
    parser.add_argument("--run", help="landing jobs: time of the run, yyyy-MM-dd HH:mm:ss")
    parser.add_argument("--runs", nargs="+", help="ref jobs: read only these landing runs")
    parser.add_argument("--since", help="dated facts: only chart days from this one on")
    parser.add_argument(
        "--ranges", nargs="+", type=_range, metavar="FIRST:LAST",
        help="land_history: only snapshots of these days, both ends included; else all",
    )
    parser.add_argument("--outer", action="store_true", help="ref jobs: keep rows without list entries")
    parser.add_argument("--dedupe", action="store_true", help="ref jobs: write each row once")
    parser.add_argument("--null-safe", action="store_true", help="loads: a null key equals a null key")
    parser.add_argument("--database", help="dated facts: register the days written; register_exports: where")
    parser.add_argument("--schema", help="csv_to_parquet: column names and types, else inferred")
    options = parser.parse_args(arguments)
    job = JOBS[options.job]
    accepted = inspect.signature(job).parameters
    extra = {k: v for k, v in vars(options).items() if k not in ("job", "root") and v}
    for name in extra:
        if name not in accepted:
            parser.error(f"{options.job} takes no --{name.replace('_', '-')}")
    if "run" in accepted and not options.run:
        parser.error(f"{options.job} needs --run")
    spark = build_session(f"chartlake {options.job}")
    try:
        job(spark, options.root.rstrip("/"), **extra)
    finally:
        spark.stop()


def _range(text: str) -> tuple[str, str]:
    first, _, last = text.partition(":")
    date.fromisoformat(first), date.fromisoformat(last or first)
    return first, last or first


if __name__ == "__main__":
    main()
