"""Structured Streaming facade."""
