"""Structured Streaming forms of the live job."""
