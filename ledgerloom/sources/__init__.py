"""Scans, sinks and staging."""
