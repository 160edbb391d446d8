"""Readers, decoders and file intake."""
