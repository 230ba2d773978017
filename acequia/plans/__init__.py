"""Composed jobs: cleaning, dimension loads, fact loads and the full run."""
