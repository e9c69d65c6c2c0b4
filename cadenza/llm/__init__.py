"""Operators for large training-text corpora.

Every operator reads whole texts, keeps its own documented parameters and runs
as Spark jobs; the ``opN_*`` functions in :mod:`cadenza.llm.queries` apply them
to the test tables.
"""
