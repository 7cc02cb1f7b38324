"""Sinks: counter store, dead letters, flat files."""
