"""Retail sales warehouse and analytics as plain Spark DataFrame transforms."""
