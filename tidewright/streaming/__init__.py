"""Structured Streaming: loading each file exactly once."""
