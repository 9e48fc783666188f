"""Incremental processing of arriving batches."""
