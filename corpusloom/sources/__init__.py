"""Scans and sinks: JSON lines, wiki XML dumps, partitioned tables."""
