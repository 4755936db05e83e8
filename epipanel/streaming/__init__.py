"""Structured Streaming forms of the weekly counts."""
