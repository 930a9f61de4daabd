"""Chart lakehouse jobs written with the PySpark DataFrame API."""

from chartlake.session import build_session

__all__ = ["build_session"]
