"""Adverse-event report analytics on Spark: landed pages to clean and analysis tables."""

from devicewatch.params import JobParams, new_run_id
from devicewatch.plans.layers import Locations, ingest, load_pages, refresh_gold, refresh_silver

__all__ = [
    "JobParams", "Locations", "ingest", "load_pages", "new_run_id", "refresh_gold",
    "refresh_silver"]
