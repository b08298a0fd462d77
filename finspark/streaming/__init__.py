"""Structured Streaming entry points.

The reference has no streaming operators (every stage is a batch run), so
nothing here adds semantics: it lets the batch upsert (R-10) consume a
stream of new rows, micro-batch by micro-batch, with the same results as
running the batch operator on the union of all batches.
"""

from .upsert_sink import upsert_stream  # noqa: F401
