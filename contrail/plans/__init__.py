"""Whole jobs: the lakehouse build, the analyst questions, the query catalogue."""
