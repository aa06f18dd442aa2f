"""Structured Streaming jobs over a stream of bars."""
