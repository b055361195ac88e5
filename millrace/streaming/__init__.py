"""Structured Streaming sources, counts and drains."""
