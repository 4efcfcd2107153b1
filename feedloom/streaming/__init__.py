"""Streaming of the content engine."""
