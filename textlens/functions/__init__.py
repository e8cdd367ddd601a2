"""Column expressions: text, vectors, edit distance."""
