"""Incremental ingest of landed pages."""
