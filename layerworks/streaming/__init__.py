"""Incremental landing of raw files with Structured Streaming."""
