"""Run the registered queries against their SQL in DuckDB and compare multisets.

``python tests/parity.py SF_DIR [name …]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark type -> the DuckDB type that must stand on the other side.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def compare(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """Rows of the Spark result, and what differs ('' if nothing does)."""
    wanted = connection.sql(sql)
    names = sorted(spark_df.columns)
    if names != sorted(wanted.columns):
        return -1, f"columns {names} != {sorted(wanted.columns)}"
    types = dict(zip(wanted.columns, map(str, wanted.types)))
    wrong = [
        f"{f.name}: {f.dataType.simpleString()} != {types[f.name]}"
        for f in spark_df.schema.fields
        if SAME_TYPE.get(f.dataType.simpleString()) != types[f.name]
    ]
    got = Counter(tuple(r[n] for n in names) for r in spark_df.collect())
    listed = ", ".join(f'"{n}"' for n in names)
    expected = Counter(wanted.project(listed).fetchall())
    if got != expected:
        missing, extra = expected - got, got - expected
        wrong.append(
            f"rows {got.total()} != {expected.total()}; "
            f"missing {missing.most_common(2)}; extra {extra.most_common(2)}"
        )
    return got.total(), "; ".join(wrong)


def main() -> None:
    import __spark_entry__ as contract
    from chartlake.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "parity", "local[8]", 8,
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
         "spark.driver.memory": "12g",
         "spark.checkpoint.dir": os.environ.get("PARITY_SHARED_DIR", "/tmp/chartlake-parity")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    sqls = contract.oracle_sql()
    for name, function in contract.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            rows, wrong = compare(df, connection, sqls[name]) if name in sqls else (df.count(), "")
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            rows, wrong = -1, f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name} {rows} {time.time() - start:.1f}s {wrong}",
              flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
