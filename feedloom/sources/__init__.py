"""Sources of the content engine."""
