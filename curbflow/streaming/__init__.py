"""Ping batches as a stream."""
