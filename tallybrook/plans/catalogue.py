"""All registered queries."""

from __future__ import annotations

from tallybrook.plans import (
    file_queries,
    log_queries,
    stream_queries,
    table_queries,
    text_queries,
)
from tallybrook.plans.tables import Query

QUERIES: dict[str, Query] = (
    log_queries.QUERIES
    | text_queries.QUERIES
    | table_queries.QUERIES
    | file_queries.QUERIES
    | stream_queries.QUERIES
)
