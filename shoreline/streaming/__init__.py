"""Structured Streaming jobs with replay-safe sinks."""
