"""Column builders: pure expressions, no actions, no Python per row."""
