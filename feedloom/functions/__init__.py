"""Functions of the content engine."""
