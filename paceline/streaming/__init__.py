"""Streaming of the time-series library."""
