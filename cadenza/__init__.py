"""Cadenza: a PySpark engine that curates speech corpora and training text."""
