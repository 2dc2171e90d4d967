"""Structured Streaming jobs for the bronze, silver and gold layers."""
