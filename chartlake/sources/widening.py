"""Reading Parquet files whose columns were written with different types.

``mergeSchema`` refuses an int beside a bigint. Here the least type that holds both is
taken for every column, at every depth, and one scan with that schema reads all files:
Spark's reader widens numbers and fills missing columns itself. Only where the types differ
in a way that it cannot widen, files are read by schema, cast and put together.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.sources.readers import listing_by_cores, partition_columns, read_parquet

# Whole numbers and fractions from narrow to wide.
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
FRACTIONS = [T.FloatType(), T.DoubleType()]
# The digits that a whole number can have.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
READERS = 8


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both.

    A whole number beside a fraction becomes a double, beside a decimal a decimal with all
    its digits; a date beside a timestamp a timestamp. What has nothing else in common
    becomes text. Structs, arrays and maps are widened inside.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if a in FRACTIONS + WHOLE and b in FRACTIONS + WHOLE:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        return _with_decimal(a, b)
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, moments) and isinstance(b, moments):
        zoned = isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType))
    return T.StringType()


def _with_decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    if a in FRACTIONS or b in FRACTIONS:
        return T.DoubleType()
    sides = []
    for x in (a, b):
        if isinstance(x, T.DecimalType):
            sides.append((x.precision - x.scale, x.scale))
        elif x in WHOLE:
            sides.append((DIGITS[x.simpleString()], 0))
        else:
            return T.StringType()
    whole, scale = (max(s) for s in zip(*sides))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of the schemas in order of appearance, each of the least common type.

    Names are compared without regard to case, as Spark does by default; the first
    spelling stays.
    """
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            key = field.name.lower()
            known = found.get(key)
            kind = wider(known.dataType, field.dataType) if known else _nullable(field.dataType)
            found[key] = T.StructField(known.name if known else field.name, kind, True)
    return T.StructType(list(found.values()))


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return common_schema([kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    return T.MapType(kind.keyType, _nullable(kind.valueType)) if isinstance(kind, T.MapType) else kind


def merged_or_none(spark: SparkSession, path: str | list[str], base: str | None = None) -> DataFrame | None:
    """The files read with ``mergeSchema``; ``None`` if their types cannot be merged."""
    reader = listing_by_cores(spark).read.option("mergeSchema", True)
    reader = reader.option("basePath", base) if base else reader
    try:
        return reader.parquet(*([path] if isinstance(path, str) else path))
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" in str(error):
            return None
        raise


def stored_schemas(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The schemas under ``path``, as JSON, each with the folders or files that have it.

    Folders are told apart first. Only in a folder whose own files cannot be merged is
    every file looked at. Schemas are read, no rows.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(path).select("path")
    )
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")
    folders = sorted(r["folder"] for r in listing.select(folder).distinct().collect())
    own: dict[str, list[str]] = {}

    def look(place: str) -> tuple[str, T.StructType | None]:
        frame = merged_or_none(spark, place)
        return place, frame and T.StructType([f for f in frame.schema.fields])

    with ThreadPoolExecutor(READERS) as pool:
        for place, schema in pool.map(look, folders):
            if schema is not None:
                own.setdefault(schema.json(), []).append(place)
                continue
            files = [r["path"] for r in listing.filter(folder == place).collect()]
            for file in sorted(files):
                own.setdefault(read_parquet(spark, file).schema.json(), []).append(file)
    return own


# What Spark's Parquet reader widens by itself.
SELF_WIDENED = {
    "tinyint": {"smallint", "int", "bigint", "double"}, "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"}, "float": {"double"}, "date": {"timestamp_ntz"},
}


def readable_as(stored: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(stored, T.StructType) and isinstance(wanted, T.StructType):
        kinds = {f.name.lower(): f.dataType for f in wanted.fields}
        return all(readable_as(f.dataType, kinds[f.name.lower()]) for f in stored.fields)
    if isinstance(stored, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return readable_as(stored.elementType, wanted.elementType)
    if isinstance(stored, T.MapType) and isinstance(wanted, T.MapType):
        return stored.keyType == wanted.keyType and readable_as(stored.valueType, wanted.valueType)
    return stored == wanted or wanted.simpleString() in SELF_WIDENED.get(stored.simpleString(), ())


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    """All files under ``path`` with every column of any of them, in the least common types.

    Columns of folder names come last, as in any partitioned read.
    """
    merged = merged_or_none(spark, path)
    if merged is not None:
        return merged
    own = stored_schemas(spark, path)
    schemas = [T.StructType.fromJson(_parsed(text)) for text in own]
    wanted = common_schema(schemas)
    if all(readable_as(schema, wanted) for schema in schemas):
        return spark.read.schema(wanted).parquet(path)
    parts = []
    for schema, places in zip(schemas, own.values()):
        part = spark.read.schema(schema).option("basePath", path).parquet(*places)
        laid_out = [c for c in partition_columns(part) if c not in schema.names]
        kinds = {f.name.lower(): f.dataType for f in wanted.fields}
        parts.append(part.select(
            *[F.col(f"`{n}`").cast(kinds[n.lower()]).alias(n) for n in schema.names],
            *[F.col(f"`{c}`") for c in laid_out],
        ))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    last = [c for c in whole.columns if c.lower() not in {n.lower() for n in wanted.names}]
    return whole.select(*[F.col(f"`{c}`") for c in (*wanted.names, *last)])


def _parsed(text: str) -> dict:
    import json

    return json.loads(text)
