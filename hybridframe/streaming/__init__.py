"""Structured Streaming jobs that feed collections."""
