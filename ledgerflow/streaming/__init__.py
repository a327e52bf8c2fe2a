"""Incremental pickup of landed feed files (Structured Streaming)."""

from ledgerflow.streaming.landed_feeds import run_landed_feeds

__all__ = ["run_landed_feeds"]
