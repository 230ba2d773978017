"""Acequia: cleaning, record linkage and star-schema loading on Spark DataFrames."""

__version__ = "0.1.0"
