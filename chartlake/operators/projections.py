"""Reading fields out of structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefixed(struct: str, fields: Sequence[str], prefix: str | None = None) -> list[Column]:
    """Fields of a struct column, named ``<prefix>_<field>``."""
    prefix = prefix or struct
    return [F.col(f"{struct}.{f}").alias(f"{prefix}_{f}") for f in fields]


def leaves(*paths: str) -> list[Column]:
    """Dotted paths; every column takes the name of its last part."""
    return [F.col(p).alias(p.rsplit(".", 1)[-1]) for p in paths]
