"""All queries of the library but those of the optional training-data operators."""

from __future__ import annotations

from . import ingest_queries, record_queries, stream_queries, text_queries  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
