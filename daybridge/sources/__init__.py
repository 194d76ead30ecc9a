"""Scans, sinks and storage locations."""
