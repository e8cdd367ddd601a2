"""Answering queries as they arrive."""
