"""Operators of the time-series library."""
