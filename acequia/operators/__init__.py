"""DataFrame-to-DataFrame operators: lazy, keyed, with explicit order columns."""
