"""Whole stages, and the query registry over the provided tables."""
