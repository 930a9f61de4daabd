"""Column helpers. Every one is a built-in expression, so it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; text that is not a date becomes null instead of failing the job.

    Text in the usual form of ten characters is cast: that gives the same days and nulls as the
    pattern, but raises nothing for a day that does not exist, which takes ten times as long.
    """
    by_pattern = F.try_to_date(text, pattern)
    if pattern != "yyyy-MM-dd":
        return by_pattern
    usual = text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}\\z")
    return F.when(usual, text.try_cast("date")).otherwise(by_pattern)


def day_text(timestamp_text: Column) -> Column:
    """The day of an ISO timestamp given as text: its first ten characters."""
    return F.substring(timestamp_text, 1, 10)


def timestamp_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text. Pass the run time in, so that a rerun repeats."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def url_last_segment(url: Column) -> Column:
    """Text after the last slash, up to the query string."""
    return F.substring_index(F.substring_index(url, "/", -1), "?", 1)


def joined(strings: Column, separator: str = ", ") -> Column:
    """Elements of a string array in one text; null elements are left out."""
    return F.concat_ws(separator, strings)


def natural_key(*parts: Column | str) -> Column:
    """Concatenate literals (given as ``str``) and columns into one text key."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def to_json_text(*columns: Column | str) -> Column:
    """One JSON object out of the given columns; nulls are kept as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def from_json_text(text: Column, ddl: str) -> Column:
    """JSON text to a typed value; text that does not parse becomes null."""
    return F.from_json(text, ddl)


def map_total(values: Column) -> Column:
    """Sum of the values of a ``map<string,double>``, added in map order."""
    return F.aggregate(F.map_values(values), F.lit(0.0), lambda acc, v: acc + v)


def two_decimals(number: Column) -> Column:
    """Text with two decimals, rounding the exact binary value half to even.

    ``format_string("%.2f")`` rounds the shortest decimal form half up instead,
    which differs for values such as 0.125 or 1.005.
    """
    return F.call_function("format_number", number, F.lit("0.00"))


def pluck(array: Column, field: str) -> Column:
    """One field of every element of an array of structs."""
    return F.transform(array, lambda element: element.getField(field))
