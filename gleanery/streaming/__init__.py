"""Incremental state over batches."""
