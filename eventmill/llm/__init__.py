"""Operators and a pipeline for language-model training data, on the driver's document tables."""
