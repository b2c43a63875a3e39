"""Structured Streaming jobs over a landing folder; one file or line is one posted event."""
