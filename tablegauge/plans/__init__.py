"""Whole evaluations put together from the operators."""
