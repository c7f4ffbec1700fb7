"""Whole jobs: configuration, the curation run, and the query catalogue."""
