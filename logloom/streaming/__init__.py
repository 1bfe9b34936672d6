"""Tailing source and delivering sinks for Structured Streaming."""
