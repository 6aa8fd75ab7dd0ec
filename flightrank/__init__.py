"""Flight-delay rankings on Spark: one set of DataFrame functions for batch and streams."""
