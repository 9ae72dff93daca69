"""Structured Streaming form of the incremental document load."""

from vaultspark.streaming.documents import stage_documents_stream

__all__ = ["stage_documents_stream"]
