"""Operators and a pipeline for preparing language-model training data."""
