"""The schema of landed JSON as the data show it, and how it changed since the last time.

Lines become variants, whose types one aggregation puts together: no field list is needed,
every line counts, and no second pass infers anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.sinks.writers import overwrite_parquet
from chartlake.sources.readers import read_parquet_if_exists

SCHEMA = "field STRING, kind STRING"
DRIFT = "field STRING, change STRING, before STRING, after STRING"


def variant_type(lines: DataFrame, column: str = "value") -> str:
    """The type of all lines together, as ``OBJECT<…>``; lines that are not JSON are left out.

    A field that has values of types with nothing in common is a ``VARIANT``; one that only
    has nulls is ``VOID``.
    """
    found = lines.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]
    return found or "VOID"


def fields_of(text: str) -> dict[str, str]:
    """The fields of a variant type by path, ``a.b`` inside objects and ``a[]`` inside lists."""
    found: dict[str, str] = {}
    schema = T.StructType.fromDDL(f"root {text.replace('OBJECT<', 'STRUCT<')}")
    _walk(schema["root"].dataType, "", found)
    return found


def _walk(kind: T.DataType, path: str, found: dict[str, str]) -> None:
    if isinstance(kind, T.StructType):
        if path:
            found[path] = "object"
        for field in kind.fields:
            _walk(field.dataType, f"{path}.{field.name}".lstrip("."), found)
    elif isinstance(kind, T.ArrayType):
        found[path or "[]"] = "list"
        _walk(kind.elementType, f"{path}[]", found)
    elif path:
        # The digits of a decimal follow the values and are no change of type.
        name = kind.simpleString()
        found[path] = "decimal" if name.startswith("decimal") else name


def inferred_fields(spark: SparkSession, path: str) -> dict[str, str]:
    """The fields of the JSON lines at ``path`` and their types."""
    return fields_of(variant_type(spark.read.text(path)))


def drift_rows(before: dict[str, str], after: dict[str, str]) -> list[tuple]:
    """(field, change, before, after) for new, missing and retyped fields."""
    return [
        (f, "missing" if f not in after else "new" if f not in before else "retyped", before.get(f), after.get(f))
        for f in sorted({*before, *after})
        if before.get(f) != after.get(f)
    ]


def check_drift(spark: SparkSession, path: str, stored: str) -> DataFrame:
    """Compare the JSON lines at ``path`` with the schema stored at ``stored``.

    Returns the differences; a first landing has none. The schema of these lines is stored
    in place of the old one.
    """
    after = inferred_fields(spark, path)
    old = read_parquet_if_exists(spark, stored, SCHEMA)
    before = after if old is None else {r["field"]: r["kind"] for r in old.collect()}
    overwrite_parquet(spark.createDataFrame(sorted(after.items()), SCHEMA).coalesce(1), stored)
    return spark.createDataFrame(drift_rows(before, after), DRIFT)
