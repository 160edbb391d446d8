"""Operators for training data: survivorship, deduplication against history, token ids, evaluation leaks, garbled text."""
