"""Operators on text corpora for training-data pipelines."""
