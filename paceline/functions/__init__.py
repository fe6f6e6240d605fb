"""Functions of the time-series library."""
