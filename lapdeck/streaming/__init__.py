"""Structured Streaming: incremental refresh when new files land."""
