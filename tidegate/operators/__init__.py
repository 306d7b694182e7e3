"""Frame-to-frame operators of the pipeline, and its tables."""
