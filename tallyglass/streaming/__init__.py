"""Incremental form of the batch run."""
