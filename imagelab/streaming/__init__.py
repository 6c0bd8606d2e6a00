"""Scoring as a Structured Streaming query."""
