"""Composed jobs (live metrics, backfill, graph export) and the query registry."""
