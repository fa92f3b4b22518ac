"""Streaming forms of the counting analyses (see ``incremental``)."""
