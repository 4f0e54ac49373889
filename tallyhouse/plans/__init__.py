"""Pipelines, reports and checks put together from the operators."""
