"""Readers and writers for corpora, dictionaries, vectors and stored indexes."""
