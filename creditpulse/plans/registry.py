"""All named queries: batch and streaming."""

from __future__ import annotations

from creditpulse.plans import queries, stream_queries

QUERIES = queries.QUERIES | stream_queries.QUERIES
