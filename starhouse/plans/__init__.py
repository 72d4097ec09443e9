"""Whole pipelines and reports put together from the operators."""
