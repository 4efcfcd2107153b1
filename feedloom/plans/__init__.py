"""Plans of the content engine."""
