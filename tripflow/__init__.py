"""Spark jobs, models and serving queries for trip-marketplace event data."""
