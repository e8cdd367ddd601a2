"""Composite jobs: building an index and answering a table of queries with it."""
