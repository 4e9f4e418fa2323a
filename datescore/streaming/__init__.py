"""Incremental execution of the daily scoring job (Structured Streaming)."""
