"""Operators for building training corpora. Nothing else in the library
imports this subpackage; its queries are in :mod:`finspark.llm.queries`."""
