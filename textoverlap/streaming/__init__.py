"""Structured Streaming entry points (the batch operators on file streams)."""

from textoverlap.streaming.ingest import start_sentence_ingest

__all__ = ["start_sentence_ingest"]
