"""Sources of the time-series library."""
