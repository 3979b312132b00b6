"""Operators and the corpus pipeline for large training-data sets."""
