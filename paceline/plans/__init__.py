"""Plans of the time-series library."""
