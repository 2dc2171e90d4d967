"""Scans: event topics, lake tables, open-data files, document corpora."""
