"""Operators of the content engine."""
