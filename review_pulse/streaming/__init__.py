"""Structured Streaming queries: scoring, mart refresh and the continuous trend."""
