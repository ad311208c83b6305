"""The query catalogue: each query next to the SQL that must give the same rows."""

from catalog import (  # noqa: F401
    answers,
    comments,
    files,
    frontier,
    instructions,
    keys,
    order,
    pages,
    scalars,
    streams,
    urls,
)
from catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
