"""Feeds in, versioned tables out, catalog listings."""
