"""Structured Streaming: files landed once, each, as they come."""
