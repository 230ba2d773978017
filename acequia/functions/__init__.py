"""Column-to-Column functions: text, values and similarity."""
